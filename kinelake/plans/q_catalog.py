"""Queries of catalog, history, reports and sampling over orders as catalog rows and events as results."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kinelake.operators import history as H
from kinelake.operators import lifecycle as L
from kinelake.operators import report as P
from kinelake.operators import sampler as G
from kinelake.operators import stats
from kinelake.operators.order import scratch
from kinelake.operators.statelog import StateLog
from kinelake.plans import surrogate as V

C = """
WITH c AS (SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_orderkey AS k, 's' || (o_orderkey % 3) AS source_id, CASE WHEN o_orderkey % 11 <> 0 THEN r_name END AS embodiment,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS task, coalesce(n, 0) AS n_frames, o_totalprice / 1000 AS duration_s,
  CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'REVIEW' ELSE 'FAIL' END AS qc_verdict,
  (['DISCOVERED', 'FETCHED', 'NORMALIZED', 'QC_DONE', 'COMMITTED', 'COMMITTED', 'FAILED'])[o_orderkey % 7 + 1] AS status,
  CASE WHEN o_orderkey % 13 <> 0 THEN 'h' END AS content_hash, CASE WHEN o_orderkey % 5 <> 0 THEN '1.1' ELSE '1.0' END AS schema_version,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'a@2' ELSE 'a@1' END AS adapter_version, CASE WHEN o_orderkey % 6 <> 0 THEN '2.1' ELSE '2.0' END AS ruleset_version
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
R = """
WITH r AS (SELECT CAST(user_id AS VARCHAR) AS uid, user_id AS u, event_type AS rule_id, 'run' || (event_id % 4) AS run_id, ts, event_id AS seq,
  (['PASS', 'PASS', 'REVIEW', 'FAIL', 'SKIPPED', 'ERROR'])[event_id % 6 + 1] AS verdict,
  CASE WHEN event_id % 6 = 4 THEN (['short', '', NULL])[event_id % 3 + 1] END AS reason, props, value FROM events),
latest AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY uid, rule_id ORDER BY ts DESC, seq DESC) = 1)
"""
_R2 = R.strip().removeprefix("WITH ")
QUERIES: dict = {}


def add(name: str, run, sql: str | None) -> None:
    QUERIES[name] = (run, sql)


def distributions(spark, sf_dir):
    out = stats.metric_distributions(V.results(spark, sf_dir), V.result_episodes(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p1", "p99")})


add("q_metric_distributions", distributions, f"""{R}, m AS (SELECT 's' || (u % 4) AS source_id, rule_id, 'k' AS metric, CAST(json_extract(props, '$.k') AS DOUBLE) AS v FROM latest UNION ALL SELECT 's' || (u % 4), rule_id, 'value', value FROM latest)
SELECT source_id, rule_id, metric, count(*) AS count, CAST(0 AS BIGINT) AS n_nan, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, min(v) AS min, max(v) AS max, round(quantile_cont(v, 0.01), 6) AS p1, round(quantile_cont(v, 0.99), 6) AS p99 FROM m GROUP BY ALL""")
add("q_latest_qc", lambda s, d: H.latest(V.results(s, d)).select("episode_uid", "rule_id", "run_id", "seq", "verdict"), f"{R} SELECT uid AS episode_uid, rule_id, run_id, seq, verdict FROM latest")
add("q_verdict_counts", lambda s, d: P.verdict_counts(V.results(s, d)), f"{R} SELECT rule_id, verdict, count(*) AS n FROM latest GROUP BY ALL")
add("q_verdict_counts_run", lambda s, d: P.verdict_counts(V.results(s, d), "run2"), f"{R} SELECT rule_id, verdict, count(*) AS n FROM r WHERE run_id = 'run2' GROUP BY ALL")
add("q_skip_reasons", lambda s, d: P.skip_reason_counts(V.results(s, d)), f"{R} SELECT rule_id, coalesce(nullif(reason, ''), 'unspecified') AS reason, count(*) AS n FROM latest WHERE verdict = 'SKIPPED' GROUP BY ALL")
add("q_skip_reasons_run", lambda s, d: P.skip_reason_counts(V.results(s, d), "run0"), f"{R} SELECT rule_id, coalesce(nullif(reason, ''), 'unspecified') AS reason, count(*) AS n FROM r WHERE verdict = 'SKIPPED' AND run_id = 'run0' GROUP BY ALL")
add("q_rules_hit", lambda s, d: P.rules_hit(V.results(s, d)).select("episode_uid", F.array_join("rules_hit", ",").alias("rules_hit")), f"{R} SELECT uid AS episode_uid, string_agg(DISTINCT rule_id, ',' ORDER BY rule_id) AS rules_hit FROM latest WHERE verdict IN ('FAIL', 'REVIEW') GROUP BY uid")
add("q_rule_rates", lambda s, d: P.rule_rates(V.results(s, d)).withColumns({c: F.round(c, 9) for c in ("hit_rate", "skip_rate")}), f"{R} SELECT rule_id, total, skipped, hits, errors, total - skipped AS evaluated, round(coalesce(hits / nullif(total - skipped, 0), 0), 9) AS hit_rate, round(skipped / total, 9) AS skip_rate FROM (SELECT rule_id, count(*) AS total, count(*) FILTER (verdict = 'SKIPPED') AS skipped, count(*) FILTER (verdict IN ('FAIL', 'REVIEW')) AS hits, count(*) FILTER (verdict = 'ERROR') AS errors FROM r GROUP BY rule_id)")
add("q_counts_by_stage", lambda s, d: P.counts_by_stage(V.catalog(s, d)), f"{C} SELECT status, count(*) AS n FROM c GROUP BY status")
add("q_corpus_totals", lambda s, d: P.corpus_totals(V.catalog(s, d)).withColumn("duration_s", F.round("duration_s", 3)), f"{C} SELECT count(*) AS n_episodes, CAST(coalesce(sum(n_frames), 0) AS BIGINT) AS n_frames, round(coalesce(sum(duration_s), 0.0), 3) AS duration_s FROM c WHERE status = 'COMMITTED'")
add("q_source_embodiment", lambda s, d: P.counts_by_source_embodiment(V.catalog(s, d)), f"{C} SELECT source_id, coalesce(embodiment, '') AS embodiment, count(*) AS n, CAST(sum(n_frames) AS BIGINT) AS n_frames FROM c WHERE status = 'COMMITTED' GROUP BY ALL")


def failures(spark, sf_dir):
    e = V.catalog(spark, sf_dir).filter("status = 'FAILED'")
    return P.failure_topn(e.select(F.concat(F.coalesce("task", F.lit(" ")), F.lit(": "), "embodiment").alias("error")))


add("q_failure_topn", failures, f"{C} SELECT coalesce(nullif(trim(split_part(e, ':', 1)), ''), 'unknown') AS reason, count(*) AS n FROM (SELECT coalesce(task, ' ') || ': ' || embodiment AS e FROM c WHERE status = 'FAILED') GROUP BY 1 ORDER BY n DESC, reason LIMIT 5")


def tallies(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    stage = F.element_at(F.array(*map(F.lit, H.STAGES[1:])), (F.col("event_id") % 3 + 1).cast("int"))
    return P.stage_tallies(e.select(stage.alias("stage"), F.col("value").alias("seconds")))


add("q_stage_tallies", tallies, "SELECT stage, round(coalesce(sum(value), 0), 3) AS seconds, count(value) AS calls FROM (SELECT unnest(['FETCHED', 'NORMALIZED', 'QC_DONE', 'COMMITTED']) AS stage) LEFT JOIN (SELECT (['FETCHED', 'NORMALIZED', 'QC_DONE', 'COMMITTED'])[event_id % 3 + 1] AS st, value FROM events) ON stage = st GROUP BY stage")
add("q_exportable", lambda s, d: G.exportable(V.catalog(s, d), True, "ASIA").select("episode_uid", "qc_verdict", "n_frames"), f"{C} SELECT uid AS episode_uid, qc_verdict, n_frames FROM c WHERE status = 'COMMITTED' AND qc_verdict IN ('PASS', 'REVIEW') AND embodiment = 'ASIA'")


def work(spark, sf_dir):
    e = V.catalog(spark, sf_dir)
    seen = e.select("episode_uid").unionByName(spark.range(0, 500).select(F.concat(F.lit("new"), F.col("id").cast("string")).alias("episode_uid")))
    return H.work_list(seen, e, "1.1", F.lit("a@2"), "2.1")


_WORK = f"""{C}, a AS (SELECT uid, status, CASE WHEN status = 'FAILED' THEN 'RETRY' WHEN status <> 'COMMITTED' THEN 'RESUME' WHEN content_hash IS NULL OR schema_version <> '1.1' OR adapter_version <> 'a@2' THEN 'REDO_NORMALIZE' WHEN ruleset_version <> '2.1' THEN 'REDO_QC' ELSE 'FRESH' END AS action FROM c
 UNION ALL SELECT 'new' || range, NULL, 'NEW' FROM range(500))
SELECT uid AS episode_uid, action, CASE action WHEN 'NEW' THEN 'DISCOVERED' WHEN 'RETRY' THEN 'DISCOVERED' WHEN 'RESUME' THEN status WHEN 'REDO_NORMALIZE' THEN 'FETCHED' ELSE 'NORMALIZED' END AS from_stage FROM a WHERE action <> 'FRESH'"""
add("q_staleness_worklist", work, _WORK)
add("q_new_episodes", lambda s, d: H.new_episodes(V.catalog(s, d).select("episode_uid"), V.table(s, d, "lineitem").filter("l_quantity < 25").select(F.col("l_orderkey").cast("string").alias("episode_uid")).distinct()), f"{C} SELECT uid AS episode_uid FROM c WHERE k NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity < 25)")


def upserted(spark, sf_dir):
    e = V.catalog(spark, sf_dir).select("episode_uid", "status")
    return H.upsert(e, e.filter("status = 'QC_DONE'").withColumn("status", F.lit("COMMITTED")), ["episode_uid"])


add("q_upsert", upserted, f"{C} SELECT uid AS episode_uid, CASE WHEN status = 'QC_DONE' THEN 'COMMITTED' ELSE status END AS status FROM c")


def transitions(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").select("event_id", F.element_at(F.array(*map(F.lit, H.STAGES)), (F.col("event_id") % 5 + 1).cast("int")).alias("from_stage"), F.element_at(F.array(*map(F.lit, [*H.STAGES, "FAILED"])), (F.col("user_id") % 6 + 1).cast("int")).alias("to_stage"), F.when(F.col("event_id") % 4 == 0, "reset").alias("reason"))
    return H.bad_transitions(e).groupBy("from_stage", "to_stage").agg(F.count(F.lit(1)).alias("n"))


add("q_bad_transitions", transitions, "SELECT (['DISCOVERED', 'FETCHED', 'NORMALIZED', 'QC_DONE', 'COMMITTED'])[a + 1] AS from_stage, (['DISCOVERED', 'FETCHED', 'NORMALIZED', 'QC_DONE', 'COMMITTED', 'FAILED'])[b + 1] AS to_stage, count(*) AS n FROM (SELECT event_id % 5 AS a, user_id % 6 AS b, event_id % 4 = 0 AS why FROM events) WHERE NOT (b = 5 OR b = a + 1 OR (b <= a AND why)) GROUP BY ALL")


def differing(spark, sf_dir):
    """Two formulations of the same counts, one of which misses rule 'error'."""
    r = V.results(spark, sf_dir)
    return P.symmetric_difference(P.verdict_counts(r), P.verdict_counts(r.filter("rule_id <> 'error'"))).groupBy("only_in").agg(F.count(F.lit(1)).alias("n"))


add("q_report_difference", differing, f"{R} SELECT 'left' AS only_in, count(*) AS n FROM (SELECT DISTINCT verdict FROM latest WHERE rule_id = 'error')")


def candidates(spark, sf_dir):
    return V.catalog(spark, sf_dir).filter("status = 'COMMITTED' AND embodiment IS NOT NULL AND n_frames > 0")


CAND = f"{C}, e AS (SELECT * FROM c WHERE status = 'COMMITTED' AND embodiment IS NOT NULL AND n_frames > 0), w AS (SELECT embodiment, CAST(sum(n_frames) AS BIGINT) AS frames FROM e GROUP BY embodiment), ws AS (SELECT *, sqrt(frames) / sum(sqrt(frames)) OVER () AS weight FROM w)"
add("q_sqrt_weights", lambda s, d: G.sqrt_weights(candidates(s, d)).withColumn("weight", F.round("weight", 9)), f"{CAND} SELECT embodiment, frames, round(weight, 9) AS weight FROM ws")


def clamped(spark, sf_dir):
    """Weights of orders by a high power of their priority, so that floor and cap both bind."""
    a = V.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.sum(F.pow(F.lit(4.0), F.substring("o_orderpriority", 1, 1).cast("int"))).alias("x"))
    raw = {r[0]: r[1] for r in a.collect()}
    total = sum(raw.values())
    out = G.clamp({k: v / total for k, v in sorted(raw.items())})
    return spark.createDataFrame([(k, round(v, 9)) for k, v in out.items()], "o_orderpriority string, weight double")


add("q_clamp", clamped, """
WITH RECURSIVE a AS (SELECT o_orderpriority AS p, sum(pow(4.0, CAST(o_orderpriority[1] AS INT))) AS x FROM orders GROUP BY 1),
s0 AS (SELECT p, x / sum(x) OVER () AS w, NULL::DOUBLE AS pin, 0 AS round FROM a),
it AS (SELECT * FROM s0 UNION ALL
  SELECT p, w, CASE WHEN pin IS NOT NULL THEN pin WHEN share < least(0.05, 1.0 / n) THEN least(0.05, 1.0 / n) WHEN share > greatest(0.4, 1.0 / n) THEN greatest(0.4, 1.0 / n) END, round + 1
  FROM (SELECT *, count(*) OVER () AS n, CASE WHEN pin IS NULL THEN w / sum(CASE WHEN pin IS NULL THEN w END) OVER () * (1 - coalesce(sum(pin) OVER (), 0)) END AS share FROM it) WHERE round < 6)
SELECT p AS o_orderpriority, round(coalesce(pin, w / sum(CASE WHEN pin IS NULL THEN w END) OVER () * (1 - coalesce(sum(pin) OVER (), 0))), 9) AS weight FROM it WHERE round = 6""")


# First fit in rounds: of what fits the rest, all up to the first that breaks the running sum; then on from there.
# f has a row per group and round (rounds have ascending p), o the ordered candidates.
_ROUNDS = """f AS (SELECT g, 0::BIGINT AS p, q AS rest FROM lim UNION ALL
   SELECT g, coalesce(min(r) FILTER (cum > rest), 9223372036854775807), rest - coalesce(max(cum) FILTER (cum <= rest), 0) FROM
     (SELECT f.g, f.p, f.rest, o.r, CAST(sum(o.n_frames) OVER (PARTITION BY f.g, f.p ORDER BY o.r) AS BIGINT) AS cum FROM f JOIN o ON o.g = f.g AND o.r > f.p AND o.n_frames <= f.rest)
   GROUP BY g, p, rest),
 got AS (SELECT g, r, uid, n_frames, source_id FROM (SELECT f.g, f.rest, o.r, o.uid, o.n_frames, o.source_id, sum(o.n_frames) OVER (PARTITION BY f.g, f.p ORDER BY o.r) AS cum FROM f JOIN o ON o.g = f.g AND o.r > f.p AND o.n_frames <= f.rest) WHERE cum <= rest)"""
_PACK = f"""{CAND.replace('WITH c', 'WITH RECURSIVE c', 1)}, lim AS (SELECT '' AS g, 400::BIGINT AS q),
 o AS (SELECT '' AS g, row_number() OVER (ORDER BY uid) AS r, uid, n_frames, source_id FROM e), {_ROUNDS}"""
add("q_sequential_pack", lambda s, d: G.plan_sequential(candidates(s, d), 400), f"{_PACK} SELECT CAST(row_number() OVER (ORDER BY r) - 1 AS INT) AS pos, uid AS episode_uid, n_frames FROM got")


def filled(c):
    quota = G.sqrt_weights(c).select("embodiment", (F.col("weight") * 1500).cast("long").alias("quota"))
    return G.first_fill(G.group_order(c, F.sha2(F.concat(F.lit("7:"), "episode_uid"), 256)), quota)


add("q_first_fill", lambda s, d: filled(candidates(s, d)), f"""{CAND.replace('WITH c', 'WITH RECURSIVE c', 1)},
 lim AS (SELECT embodiment AS g, CAST(trunc(weight * 1500) AS BIGINT) AS q FROM ws),
 b AS (SELECT *, CASE WHEN qc_verdict = 'PASS' THEN 0 ELSE 1 END AS tier, coalesce(task, '') AS tk FROM e),
 t AS (SELECT *, row_number() OVER (PARTITION BY embodiment, tier, source_id, tk ORDER BY sha256('7:' || uid), uid) AS rd FROM b),
 o AS (SELECT embodiment AS g, uid, n_frames, source_id, row_number() OVER (PARTITION BY embodiment ORDER BY tier, rd, source_id, tk) AS r FROM t), {_ROUNDS}
SELECT g AS embodiment, CAST(row_number() OVER (PARTITION BY g ORDER BY r) - 1 AS INT) AS pos, uid AS episode_uid FROM got""")
add("q_group_order", lambda s, d: G.group_order(candidates(s, d), F.lit("")).select("embodiment", "episode_uid", "turn"), f"""{CAND}, t AS (SELECT *, CASE WHEN qc_verdict = 'PASS' THEN 0 ELSE 1 END AS tier, coalesce(task, '') AS tk, row_number() OVER (PARTITION BY embodiment, CASE WHEN qc_verdict = 'PASS' THEN 0 ELSE 1 END, source_id, coalesce(task, '') ORDER BY uid) AS rd FROM e)
SELECT embodiment, uid AS episode_uid, CAST(row_number() OVER (PARTITION BY embodiment ORDER BY tier, rd, source_id, tk) AS INT) AS turn FROM t""")
add("q_balanced_plan", lambda s, d: G.plan_balanced(candidates(s, d), 2000, seed=7)[0], None)
add("q_balanced_groups", lambda s, d: G.plan_balanced(candidates(s, d), 2000, seed=7)[1].select("embodiment", "n_eligible", "frames_eligible", F.round("weight", 9).alias("weight")), f"{CAND}, n AS (SELECT embodiment, count(*) AS n_eligible FROM e GROUP BY embodiment) SELECT embodiment, n_eligible, frames AS frames_eligible, round(weight, 9) AS weight FROM ws JOIN n USING (embodiment)")


def _balanced_sql(budget: int) -> str:
    """The balanced plan without a seed, one decision after the other. A row of s is the state between two of them: the
    phase (0 first shares, 1 shares of the rest, 2 the rest whole), the groups still to be served in it, how far the
    first of them is, what groups may take and have taken, what is left, and the episodes taken so far."""
    put = lambda a, new: f"list_transform(range(1, len({a}) + 1), lambda i: CASE WHEN i = todo[1] THEN {new} ELSE {a}[i] END)"
    return f"""{CAND.replace('WITH c', 'WITH RECURSIVE c', 1)},
 t AS (SELECT *, CASE WHEN qc_verdict = 'PASS' THEN 0 ELSE 1 END AS tier, coalesce(task, '') AS tk, row_number() OVER (PARTITION BY embodiment, CASE WHEN qc_verdict = 'PASS' THEN 0 ELSE 1 END, source_id, coalesce(task, '') ORDER BY uid) AS rd FROM e),
 gs AS (SELECT embodiment, weight, row_number() OVER (ORDER BY embodiment) AS g FROM ws),
 o AS MATERIALIZED (SELECT g, uid, n_frames AS n, row_number() OVER (PARTITION BY embodiment ORDER BY tier, rd, source_id, tk) AS r FROM t JOIN gs USING (embodiment)),
 s AS (SELECT 0 AS phase, (SELECT list(g ORDER BY g) FROM gs) AS todo, 0::BIGINT AS p, (SELECT list(CAST(trunc(weight * {budget}) AS BIGINT) ORDER BY g) FROM gs) AS allowed, (SELECT list(0::BIGINT ORDER BY g) FROM gs) AS spent,
    {budget}::BIGINT AS free, {budget}::BIGINT AS began, []::BIGINT[] AS taken
  UNION ALL
  SELECT
    CASE WHEN len(todo) > 0 THEN phase WHEN able IS NULL OR phase = 2 THEN 9 WHEN phase = 1 AND free = began THEN 2 ELSE 1 END,
    CASE WHEN len(todo) > 0 AND k > 0 THEN todo WHEN len(todo) > 0 THEN todo[2:] ELSE able END,
    CASE WHEN len(todo) > 0 AND k > 0 THEN coalesce(stop, 9223372036854775807) ELSE 0 END,
    CASE WHEN len(todo) > 0 OR able IS NULL THEN allowed WHEN phase = 1 AND free = began THEN list_transform(range(1, len(allowed) + 1), lambda i: CASE WHEN list_contains(able, i) THEN {budget} ELSE allowed[i] END)
      ELSE list_transform(range(1, len(allowed) + 1), lambda i: CASE WHEN list_contains(able, i) THEN allowed[i] + CAST(trunc(free * shares[list_position(able, i)]) AS BIGINT) ELSE allowed[i] END) END,
    CASE WHEN len(todo) > 0 AND k > 0 THEN {put("spent", "spent[i] + coalesce(gained, 0)")} ELSE spent END,
    free - CASE WHEN len(todo) > 0 THEN coalesce(gained, 0) ELSE 0 END,
    CASE WHEN len(todo) = 0 THEN free ELSE began END,
    CASE WHEN len(todo) > 0 THEN list_concat(taken, coalesce(keys, [])) ELSE taken END
  FROM s,
    LATERAL (SELECT count(*) AS k, min(r) FILTER (cum > cap) AS stop, max(cum) FILTER (cum <= cap) AS gained, list(todo[1] * 1000000000 + r ORDER BY r) FILTER (cum <= cap) AS keys FROM
       (SELECT r, least(s.allowed[s.todo[1]] - s.spent[s.todo[1]], s.free) AS cap, CAST(sum(n) OVER (ORDER BY r) AS BIGINT) AS cum FROM o
        WHERE o.g = s.todo[1] AND o.r > s.p AND o.n <= least(s.allowed[s.todo[1]] - s.spent[s.todo[1]], s.free) AND NOT list_contains(s.taken, o.g * 1000000000 + o.r))) a,
    LATERAL (SELECT list(g ORDER BY weight DESC, embodiment) AS able, list(weight / total ORDER BY weight DESC, embodiment) AS shares FROM
       (SELECT *, sum(weight) OVER () AS total FROM gs WHERE g IN (SELECT o.g FROM o WHERE o.n <= s.free AND NOT list_contains(s.taken, o.g * 1000000000 + o.r)))) b
  WHERE phase <> 9),
 fin AS (SELECT allowed, spent, taken FROM s WHERE phase = 9),
 got AS (SELECT key // 1000000000 AS g, key % 1000000000 AS r, nth FROM (SELECT unnest(taken) AS key, generate_subscripts(taken, 1) AS nth FROM fin))"""


_BALANCED = _balanced_sql(2000)
add("q_balanced_plan_in_order", lambda s, d: G.plan_balanced(candidates(s, d), 2000)[0], f"{_BALANCED} SELECT CAST(row_number() OVER (ORDER BY got.g, nth) - 1 AS INT) AS pos, embodiment, uid AS episode_uid, n AS n_frames FROM got JOIN o ON o.g = got.g AND o.r = got.r JOIN gs ON gs.g = got.g")
add("q_balanced_allocation", lambda s, d: G.plan_balanced(candidates(s, d), 2000)[1].select("embodiment", "quota", "n_selected", "frames_selected"), f"{_BALANCED} SELECT embodiment, allowed[gs.g] AS quota, count(got.r) AS n_selected, spent[gs.g] AS frames_selected FROM gs CROSS JOIN fin LEFT JOIN got ON got.g = gs.g GROUP BY ALL")


def exported(spark, sf_dir):
    plan = G.plan_sequential(candidates(spark, sf_dir), 400)
    licences = spark.createDataFrame([("s0", "mit"), ("s1", "cc-by")], "source_id string, licence string")
    e = V.catalog(spark, sf_dir).select("episode_uid", "source_id", "embodiment", "n_frames", "qc_verdict")
    hits = P.rules_hit(V.results(spark, sf_dir))
    lines = G.manifest(plan, e, licences, hits)
    return lines.select("pos", F.get_json_object("line", "$.episode_uid").alias("episode_uid"), F.get_json_object("line", "$.licence").alias("licence"), F.get_json_object("line", "$.frame_end").cast("long").alias("frame_end"))


add("q_export_manifest", exported, f"{_PACK} SELECT CAST(row_number() OVER (ORDER BY r) - 1 AS INT) AS pos, uid AS episode_uid, CASE source_id WHEN 's0' THEN 'mit' WHEN 's1' THEN 'cc-by' END AS licence, CAST(n_frames AS BIGINT) AS frame_end FROM got")


def full_export(spark, sf_dir):
    """A sequential plan's lines with all their fields; channels are the event stream's, given to every embodiment."""
    e = V.catalog(spark, sf_dir)
    plan = G.plan_sequential(candidates(spark, sf_dir), 400)
    told = e.select(
        "episode_uid", "source_id", "embodiment", "task", "n_frames", "duration_s", "qc_verdict", "schema_version", F.lit("per_frame_continuous").alias("action_level"), F.lit(10.0).alias("fps_nominal"), F.lit(9.5).alias("fps_effective"),
        F.struct(F.lit(True).alias("has_action")).alias("capabilities"), F.struct(F.lit("unknown").alias("end_reason")).alias("boundary"), F.concat(F.lit("x/"), "episode_uid").alias("frames_path"), F.array(F.lit("done")).alias("raw_frame_columns"),
    )
    regions = V.table(spark, sf_dir, "region").select(F.col("r_name").alias("embodiment"))
    channels = V.event_tables(spark, sf_dir).channels.filter("embodiment = 'odd'").drop("embodiment").crossJoin(F.broadcast(regions))  # five by three
    licences = spark.createDataFrame([("s0", "mit"), ("s1", "cc-by")], "source_id string, licence string")
    lines = V.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("episode_uid"), F.lit("action").alias("signal"), F.lit("value").alias("channel")).agg(F.count(F.lit(1)).alias("count"), F.max("l_quantity").alias("max"))
    return G.full_manifest(plan, told, channels, licences, P.rules_hit(V.results(spark, sf_dir)), lines)


_TAKEN = f"{_PACK} SELECT CAST(row_number() OVER (ORDER BY r) - 1 AS INT) AS pos, got.uid, got.n_frames, got.source_id FROM got"
def manifest_fields(spark, sf_dir):
    """Every field of every line, numbers apart from texts."""
    line = full_export(spark, sf_dir)
    text = [F.get_json_object("line", f"$.{k}").alias(k) for k in G.FIELDS if k not in ("key_stats", "duration_s")]
    stats_of = [F.get_json_object("line", f"$.key_stats['action.value'].{k}").cast("double").alias(f"stats_{k}") for k in ("count", "max")]
    return line.select("pos", *text, F.round(F.get_json_object("line", "$.duration_s").cast("double"), 6).alias("duration_s"), *stats_of, F.size(F.json_object_keys("line")).alias("n_fields"))


add("q_full_manifest", manifest_fields, f"""{_PACK}, l AS (SELECT l_orderkey AS k, max(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY l_orderkey), {_R2},
hits AS (SELECT uid, '["' || string_agg(DISTINCT rule_id, '","' ORDER BY rule_id) || '"]' AS hit FROM latest WHERE verdict IN ('FAIL', 'REVIEW') GROUP BY uid)
SELECT CAST(row_number() OVER (ORDER BY got.r) - 1 AS INT) AS pos, got.uid AS episode_uid, CASE got.source_id WHEN 's0' THEN 'mit' WHEN 's1' THEN 'cc-by' END AS license, e.task, 'cartesian_2d' AS action_space, '2' AS action_dim, '1' AS physical_dim, 'true' AS action_is_delta,
  'per_frame_continuous' AS action_level, '{{"end_reason":"unknown"}}' AS boundary, '{{"has_action":true}}' AS capabilities, e.embodiment, '9.5' AS fps_effective, '10.0' AS fps_nominal, '0' AS frame_start, CAST(got.n_frames AS VARCHAR) AS frame_end, CAST(got.n_frames AS VARCHAR) AS n_frames,
  'x/' || got.uid AS frames_path, coalesce(hit, '[]') AS qc_rules_hit, e.qc_verdict, '["done"]' AS raw_frame_columns, e.schema_version, e.source_id, round(e.duration_s, 6) AS duration_s, CAST(l.n AS DOUBLE) AS stats_count, CAST(q AS DOUBLE) AS stats_max, CAST(24 AS INT) AS n_fields
FROM got JOIN e ON e.uid = got.uid JOIN l ON l.k = e.k LEFT JOIN hits ON hits.uid = got.uid""")
add("q_export_audit", lambda s, d: G.audit(G.plan_sequential(candidates(s, d), 400), None, "out/plan.jsonl", "run1", "sequential", 400, "2026-01-01T00:00:00Z").select("export_id", "n_episodes", "n_frames", F.get_json_object("stats", "$.shortfall_frames").alias("shortfall")), f"{_PACK} SELECT 'plan.jsonl@2026-01-01T00:00:00Z' AS export_id, count(*) AS n_episodes, CAST(sum(n_frames) AS BIGINT) AS n_frames, CAST(400 - sum(n_frames) AS VARCHAR) AS shortfall FROM got")


def sections(spark, sf_dir):
    """A report of the corpus and of run 2, a row for each of its lines but rates, which are rounded."""
    e, r = V.catalog(spark, sf_dir), V.results(spark, sf_dir)
    report = P.build(e, r, {"run_id": "run2", "stats": {}})
    problems, _ = P.disagreements(report, e, r)
    whole = {s.title for s in P.SECTIONS} - {"Rule rates", "Committed corpus"}
    rows = [(t, ",".join(map(str, row))) for t, s in report["sections"].items() if t in whole for row in s["rows"]]
    rows += [("Rule rates", ",".join(map(str, row[:5]))) for row in report["sections"]["Rule rates"]["rows"]]
    rows += [("Committed corpus", ",".join(map(str, row[:2]))) for row in report["sections"]["Committed corpus"]["rows"]]
    return spark.createDataFrame([*rows, *(("problem", p) for p in problems)], "section string, line string")


_WHY = "coalesce(nullif(reason, ''), 'unspecified')"
add("q_report_sections", sections, f"""{C}, {_R2}
SELECT 'Episodes by stage' AS section, status || ',' || count(*) AS line FROM c GROUP BY status
UNION ALL SELECT 'Committed corpus', count(*) || ',' || CAST(sum(n_frames) AS BIGINT) FROM c WHERE status = 'COMMITTED'
UNION ALL SELECT 'Committed by source and embodiment', source_id || ',' || coalesce(embodiment, '') || ',' || count(*) || ',' || CAST(sum(n_frames) AS BIGINT) FROM c WHERE status = 'COMMITTED' GROUP BY source_id, coalesce(embodiment, '')
UNION ALL SELECT 'Verdicts of this run', rule_id || ',' || verdict || ',' || count(*) FROM r WHERE run_id = 'run2' GROUP BY rule_id, verdict
UNION ALL SELECT 'Skips of this run', rule_id || ',' || {_WHY} || ',' || count(*) FROM r WHERE run_id = 'run2' AND verdict = 'SKIPPED' GROUP BY rule_id, {_WHY}
UNION ALL SELECT 'Verdicts', rule_id || ',' || verdict || ',' || count(*) FROM latest GROUP BY rule_id, verdict
UNION ALL SELECT 'Rule rates', rule_id || ',' || count(*) FILTER (verdict <> 'SKIPPED') || ',' || count(*) FILTER (verdict IN ('FAIL', 'REVIEW')) || ',' || count(*) FILTER (verdict = 'SKIPPED') || ',' || count(*) FILTER (verdict = 'ERROR') FROM latest GROUP BY rule_id
UNION ALL SELECT 'Skips', rule_id || ',' || {_WHY} || ',' || count(*) FROM latest WHERE verdict = 'SKIPPED' GROUP BY rule_id, {_WHY}""")


def states(spark, sf_dir):
    """Orders as rows of state: two thirds are leased, some without an end."""
    o, k = V.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    return o.select(k.cast("string").alias("episode_uid"), F.when(k % 3 != 0, F.concat(F.lit("w"), (k % 2).cast("string"))).alias("lease_owner"), F.when(k % 5 != 0, F.timestamp_seconds(k)).alias("lease_expires_at"), (k % 4).cast("int").alias("attempt"))


add("q_expired_leases", lambda s, d: L.expired(states(s, d), F.timestamp_seconds(F.lit(2000)), "w1").select("episode_uid", "lease_owner"), "SELECT CAST(o_orderkey AS VARCHAR) AS episode_uid, 'w' || (o_orderkey % 2) AS lease_owner FROM orders WHERE o_orderkey % 3 <> 0 AND (o_orderkey % 5 = 0 OR o_orderkey <= 2000 OR o_orderkey % 2 = 1)")
add("q_lease_attempts", lambda s, d: L.leased(V.catalog(s, d).filter("status = 'FETCHED'"), states(s, d).filter("attempt > 0"), "w0", F.timestamp_seconds(F.lit(0)), 60).select("episode_uid", "attempt", F.unix_timestamp("lease_expires_at").alias("until")), f"{C} SELECT uid AS episode_uid, CAST(k % 4 + 1 AS INT) AS attempt, CAST(60 AS BIGINT) AS until FROM c WHERE status = 'FETCHED'")
add("q_requeued", lambda s, d: L.requeued(V.catalog(s, d).filter("status = 'FAILED'"), "DISCOVERED", "retry", "r9", F.timestamp_seconds(F.lit(0))).select("episode_uid", "status", "qc_verdict", "last_update_run"), f"{C} SELECT uid AS episode_uid, 'DISCOVERED' AS status, 'PENDING' AS qc_verdict, 'r9' AS last_update_run FROM c WHERE status = 'FAILED'")
add("q_advanced", lambda s, d: L.advanced(V.catalog(s, d).filter("status = 'FETCHED'"), "NORMALIZED", "r9", F.timestamp_seconds(F.lit(0)), content_hash=F.lit("h")).groupBy("status", "content_hash").agg(F.count(F.lit(1)).alias("n")), f"{C} SELECT 'NORMALIZED' AS status, 'h' AS content_hash, count(*) AS n FROM c WHERE status = 'FETCHED'")


def recovered(spark, sf_dir):
    """Orders as runs, open where their status is; catalog rows as state, of which those with an odd key can be read."""
    o = V.table(spark, sf_dir, "orders")
    runs = o.select(F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderdate").cast("string").alias("started_at"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderstatus") != "P", F.lit("x")).alias("finished_at"))
    state = V.catalog(spark, sf_dir).select("episode_uid", "status")
    found = H.recover(runs, state, state.filter("CAST(episode_uid AS BIGINT) % 2 = 1"), F.lit("now"))
    count = lambda k: found[k].agg(F.lit(k).alias("what"), F.count(F.lit(1)).cast("string").alias("value"))
    return count("interrupted").unionByName(found["resumed_from"].select(F.lit("resumed_from").alias("what"), F.col("run_id").alias("value"))).unionByName(count("demoted"))


add("q_recover", recovered, f"""{C} SELECT 'interrupted' AS what, CAST(count(*) AS VARCHAR) AS value FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'resumed_from', CAST(max_by(o_orderkey, (o_orderdate, o_orderkey)) AS VARCHAR) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'demoted', CAST(count(*) AS VARCHAR) FROM c WHERE status IN ('NORMALIZED', 'QC_DONE') AND k % 2 = 0""")


# ---- the log of states


def _logged(spark, sf_dir) -> StateLog:
    """Results as a log: three commits by number of the result, with snapshots between them."""
    r = V.results(spark, sf_dir).select("episode_uid", "rule_id", "run_id", "created_at", "seq", "verdict")
    log = StateLog(spark, scratch(spark, "results"), r.schema, keys=("episode_uid", "rule_id"), order=("created_at", "seq"), buckets=8)
    # in order of time, as commits are
    third = F.ntile(3).over(Window.orderBy("day"))
    days = r.select(F.to_date("created_at").alias("day")).distinct().withColumn("part", third)  # a row a day
    parts = r.withColumn("day", F.to_date("created_at")).join(F.broadcast(days), "day")
    for k in (1, 2, 3):
        log.append(parts.filter(F.col("part") == k).drop("day", "part"), token=f"part{k}")
        if k < 3:
            log.compact()
    return log


add("q_log_latest", lambda s, d: _logged(s, d).latest().select("episode_uid", "rule_id", "run_id", "seq", "verdict"), f"{R} SELECT uid AS episode_uid, rule_id, run_id, seq, verdict FROM latest")


def _catalogued(spark, sf_dir) -> StateLog:
    """The catalog as a log: all episodes as discovered, then every one of them as it is, and a snapshot."""
    e = V.catalog(spark, sf_dir).select("episode_uid", "source_id", "status", "qc_verdict", "n_frames")
    log = StateLog(spark, scratch(spark, "episodes"), e.schema, buckets=16)
    log.append(e.withColumns({"status": F.lit("DISCOVERED"), "qc_verdict": F.lit("PENDING")}))
    log.compact()
    log.append(e.filter("status <> 'DISCOVERED'"))
    log.compact()
    return log


def by_stage(spark, sf_dir):
    return _catalogued(spark, sf_dir).latest(F.col("status").isin("NORMALIZED", "QC_DONE")).select("episode_uid", "source_id", "status", "qc_verdict")


add("q_by_stage", by_stage, f"{C} SELECT uid AS episode_uid, source_id, status, qc_verdict FROM c WHERE status IN ('NORMALIZED', 'QC_DONE')")


def by_uid(spark, sf_dir):
    """The episode of the largest order, looked up in its bucket."""
    uid = V.table(spark, sf_dir, "orders").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey"))).first()[0]
    return _catalogued(spark, sf_dir).lookup(episode_uid=str(uid)).select("episode_uid", "source_id", F.col("n_frames").cast("long").alias("n_frames"))


add("q_by_uid", by_uid, f"{C} SELECT uid AS episode_uid, source_id, n_frames FROM c WHERE k = (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1)")


def ingested(spark, sf_dir):
    """All orders through a run in two batches: a fifth of the customers' cannot be fetched, every line's quantity counts as
    a frame, and an order of more than five lines is for review."""
    o = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("episode_uid"), (F.col("o_custkey") % 5 == 0).alias("lost"))
    lines = V.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("frame_idx"), F.col("l_quantity").alias("value"))
    place = scratch(spark, "ingested")

    def fetch(e):
        return e.join(o, "episode_uid").select("episode_uid", F.when(F.col("lost"), F.concat(F.lit("NotFound: "), "episode_uid")).alias("error"))

    def normalize(e):  # what every line says alike comes behind the join
        mine = lines.join(e.select(F.col("episode_uid").cast("long").alias("l_orderkey")), "l_orderkey", "left_semi")
        return mine.select(F.col("l_orderkey").cast("string").alias("episode_uid"), F.lit("src").alias("source_id"), "frame_idx", "value")

    def judge(e):
        n = spark.read.parquet(f"{place}/frames").groupBy("episode_uid").agg(F.count(F.lit(1)).alias("n")).join(e.select("episode_uid"), "episode_uid", "left_semi")
        return n.select("episode_uid", F.when(F.col("n") > 5, "REVIEW").otherwise("PASS").alias("qc_verdict"))

    source = L.Source(lambda: o, fetch, normalize, judge, lambda rows: rows.write.mode("append").parquet(f"{place}/frames"))
    log = L.episode_log(spark, place)
    return L.ingest(log, L.due(o, log), source, L.Run("r1"), batches=2).select("episode_uid", "status", "qc_verdict", "last_error")


add("q_ingest", ingested, """SELECT CAST(o_orderkey AS VARCHAR) AS episode_uid, CASE WHEN o_custkey % 5 = 0 THEN 'FAILED' WHEN n IS NULL THEN 'FETCHED' ELSE 'COMMITTED' END AS status,
 CASE WHEN o_custkey % 5 = 0 OR n IS NULL THEN 'PENDING' WHEN n > 5 THEN 'REVIEW' ELSE 'PASS' END AS qc_verdict, CASE WHEN o_custkey % 5 = 0 THEN 'NotFound: ' || o_orderkey END AS last_error
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""")


def large_groups(spark, sf_dir):
    """Summaries of line prices by return flag with quantiles selected by counting, as if no task could hold a group."""
    rows = V.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_extendedprice").alias("value"))
    out = stats.distributions(rows, ["l_returnflag", "l_linestatus"], in_a_task=0)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p1", "p99")})


add("q_large_group_quantiles", large_groups, """SELECT l_returnflag, l_linestatus, count(*) AS count, CAST(0 AS BIGINT) AS n_nan, round(avg(l_extendedprice), 6) AS mean, round(stddev_pop(l_extendedprice), 6) AS std,
 min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(quantile_cont(l_extendedprice, 0.01), 6) AS p1, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem GROUP BY ALL""")
