"""Declarations of sources, embodiments and rules, read on the driver from JSON and made into small tables.

A source's settings are the defaults, then its own entry, then a local overlay; keys that are not settings go to
`options`. A rule's parameters come from its entry; a rule can be switched off.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from kinelake.operators import rules as R
from kinelake.operators.rules import CHANNEL

SETTINGS = ("source_id", "kind", "uri", "revision", "licence", "embodiment", "max_episodes", "enabled")


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def sources(config: dict, overlay: dict | None = None) -> list[dict]:
    out = []
    for name, entry in sorted(config.get("sources", {}).items()):
        merged = config.get("defaults", {}) | entry | (overlay or {}).get(name, {})
        row = {k: merged.get(k) for k in SETTINGS} | {"source_id": name}
        row["options"] = {k: str(v) for k, v in sorted(merged.items()) if k not in SETTINGS}
        out.append(row)
    return out


def source_table(spark: SparkSession, config: dict, overlay: dict | None = None) -> DataFrame:
    schema = "source_id string, kind string, uri string, revision string, licence string, embodiment string, max_episodes int, enabled boolean, options map<string,string>"
    return spark.createDataFrame([tuple(r.values()) for r in sources(config, overlay)], schema)


def channel_rows(embodiments: dict) -> list[tuple]:
    """Rows of `channels`; places of physical channels count on their own."""
    rows = []
    for e, signals in sorted(embodiments.items()):
        for s, declared in sorted(signals.items()):
            physical = 0
            for pos, c in enumerate(declared):
                real = c.get("is_physical", True)
                limits = [None if c.get(k) is None else float(c[k]) for k in ("min", "max")]
                rows.append((e, s, c["name"], pos, real, c.get("is_delta", False), *limits, c.get("space", "unknown"), c.get("role", "unknown"), c.get("origin", "measured"), c.get("unit"), physical if real else None))
                physical += real
    return rows


def channel_table(spark: SparkSession, embodiments: dict) -> DataFrame:
    return spark.createDataFrame(channel_rows(embodiments), CHANNEL)


def rules(config: dict) -> list[R.Rule]:
    """The rules that are not switched off, with the configured parameters over their own."""
    out = []
    for rule in R.RULES:
        entry = config.get(rule.rule_id, {})
        unknown = set(entry.get("params", {})) - set(rule.params)
        if unknown:
            raise ValueError(f"{rule.rule_id} has no {', '.join(sorted(unknown))}")
        if entry.get("enabled", True):
            out.append(replace(rule, params=rule.params | entry.get("params", {})))
    return out
