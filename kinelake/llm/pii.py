"""Personal data replaced by format-preserving Feistel pseudonyms, with DataFrame functions only.

Candidates are found by one pattern and validated by kind; what does not validate stays as it is. A validated value is
permuted under a key among the values of its own format, so that equal values get equal pseudonyms in every document
and different ones stay different:

| kind | validation | permuted | kept |
| card | 13 to 19 digits, Luhn; also as whole groups among other numbers | all digits but the last | separators; the last digit is the new Luhn digit |
| phone | 8 to 15 digits, with + or a usual grouping | all digits but the country code's | separators, country code |
| ssn | area not 000, 666 or 9xx, group not 00, serial not 0000 | area, group and serial | hyphens |
| iban | length, mod 97; also as whole groups before other words | digits of the account | letters, country; the check digits are new |
| ip | four octets to 255 | the 32 bits | |
| date | in the calendar, 1900 to 2099 | the day among all these days | order and separators |
| email | shape of an address | letters and digits of the local part | case, other characters, domain |
| secret | hex of 32 digits or more behind "token =" and the like | each hex digit | case, length |

The permutation is an alternating Feistel network on a product of two ranges a x b (so that every result is in range):
left += F(right) mod a, right += F(left) mod b, ROUNDS times, with F from sha-256 of key, kind, round and value.
Texts over letters and digits use the same network with character-wise addition within each character's class.

Defined results: a null text stays null with counts 0; an empty text stays empty; repeated rows are each replaced
alike; an empty table gives an empty one; columns of docs are kept, but those called as a count give way to it, and the
text column's name is free. A text of any length is searched whole; one without a digit, an @ or a run of 32 hex digits
can have no value and is not searched at all.

Not taken for personal data: account numbers in lower case, groups parted by line breaks or no-break spaces, phones with
00 for the +, and the letters beyond ASCII of an address, which stay where they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinelake.llm.store import fresh, quoted

ROUNDS = 10
#: Days from 1900-01-01 to 2099-12-31 are 17 * 4297.
DAYS = 17, 4297

# Patterns of the kinds; every one starts at an edge and repeats in bounds, so that long runs stay linear.
#: Letters of the local part may be Latin, Greek or Cyrillic; only scripts that put spaces between words.
_LOCAL = r"A-Za-z0-9._+\-\u00C0-\u02AF\u0370-\u052F"
EMAIL = rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+@(?:[A-Za-z0-9\-]{{1,63}}+\.){{1,8}}[A-Za-z]{{2,24}}(?![A-Za-z0-9])"
SECRET = r"(?<=(?:[Tt]oken|TOKEN|[Kk]ey|KEY|[Ss]ecret|SECRET|[Pp]assword|PASSWORD)[ ]{0,2}[=:][ ]{0,2}[\"']?)[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])"
#: Lengths of account numbers by country; others are looked for in groups of four.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
_BY_LENGTH = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, c in IBAN_LENGTHS.items())
IBAN = rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_BY_LENGTH}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9\-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9\-])"
DAY_DATE = r"(?<![0-9./])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9])"
MONTH_DATE = r"(?<![0-9./])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])"
SSN = r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"
PHONE = r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){1,4}(?![0-9])"
LOCAL_PHONE = r"(?<![0-9\-.])(?:\([0-9]{3}\) ?|[0-9]{3}[.\-])[0-9]{3}[.\-][0-9]{4}(?![0-9\-])"
#: A run of digit groups up to a value of another kind; possessive, so that Java matches it in a loop. One that starts
#: with more digits than a card has is left out; cards inside a run are found by `parts`.
OTHERS = "|".join([IP, ISO_DATE, DAY_DATE, MONTH_DATE, SSN, LOCAL_PHONE])
CARD = rf"(?<![0-9])(?<![0-9][.\-])(?![0-9]{{20}})[0-9](?:(?:[ \-](?!{OTHERS}))?[0-9]){{12,}}+"
PATTERN = "|".join([EMAIL, SECRET, IBAN, IP, ISO_DATE, DAY_DATE, MONTH_DATE, SSN, PHONE, LOCAL_PHONE, CARD])
KINDS = "email", "secret", "iban", "ip", "date", "ssn", "phone", "card"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _long(c: Column) -> Column:
    return c.cast("long")


def _number(key: str, tweak: str, i: Column, x: Column) -> Column:
    """The round function: 60 bits of a keyed hash."""
    return _long(F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i.cast("string"), x.cast("string"), F.lit(key)), 256), 1, 15), 16, 10))


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tweak: str, back: bool = False) -> Column:
    """struct(l, r): the place of (left, right) in range(a) x range(b) after the keyed permutation; `back` undoes it."""
    sign = -1 if back else 1

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(s["l"] + sign * (_number(key, tweak, i, s["r"]) % s["a"]), s["a"])).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise(F.pmod(s["r"] + sign * (_number(key, tweak, i, s["l"]) % s["b"]), s["b"])).alias("r"),
            s["a"].alias("a"),
            s["b"].alias("b"),
        )

    start = F.struct(_long(left).alias("l"), _long(right).alias("r"), _long(a).alias("a"), _long(b).alias("b"))
    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    return F.aggregate(F.array(*map(F.lit, rounds)), start, step)


def _let(x: Column, f) -> Column:
    """f(x) with x computed once."""
    return F.transform(F.array(x), f)[0]


def permute_digits(digits: Column, key: str, tweak: str, back: bool = False) -> Column:
    """A string of 2 to 18 digits among all strings of its length."""
    u = F.floor(F.length(digits) / 2).cast("int")
    v = F.length(digits) - u
    ten = lambda n: _long(F.rpad(F.lit("1"), n + 1, F.lit("0")))
    left, right = F.substring(digits, F.lit(1), u), F.substring(digits, u + 1, v)
    return _let(F.struct(feistel(left, right, ten(u), ten(v), key, tweak, back).alias("f"), u.alias("u"), v.alias("v")), lambda s: F.concat(F.lpad(s["f"]["l"].cast("string"), s["u"], F.lit("0")), F.lpad(s["f"]["r"].cast("string"), s["v"], F.lit("0"))))


def permute_text(text: Column, key: str, tweak: str, digits: str = "0123456789", lower: str = LOWER, upper: str = UPPER, back: bool = False) -> Column:
    """Characters of each class among those of the class; all others stay. Halves of the text feed each other."""
    sign = -1 if back else 1

    def shift(half: Column, other: Column, i: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i.cast("string"), other, F.lit(key)), 256)

        def one(c: Column, j: Column, h: Column) -> Column:
            add = F.conv(F.substring(h, (j % 31) * 2 + 1, F.lit(4)), 16, 10).cast("int") + F.floor(j / 31).cast("int")
            moved = lambda s: F.substring(F.lit(s), F.pmod(F.instr(F.lit(s), c) - 1 + sign * add, F.lit(len(s))) + 1, F.lit(1))
            out = c
            for s in (digits, lower, upper):
                if s:
                    out = F.when(F.instr(F.lit(s), c) > 0, moved(s)).otherwise(out)
            return out

        return _let(stream, lambda h: F.array_join(F.transform(F.filter(F.split(half, ""), lambda c: c != ""), lambda c, j: one(c, j, h)), ""))

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, shift(s["l"], s["r"], i)).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(shift(s["r"], s["l"], i)).alias("r"))

    u = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), u).alias("l"), F.substring(text, u + 1, F.length(text)).alias("r"))
    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    return _let(F.aggregate(F.array(*map(F.lit, rounds)), start, step), lambda s: F.concat(s["l"], s["r"]))


def only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def put_digits(format_: Column, digits: Column) -> Column:
    """The format with its digits replaced by these, in order."""
    pieces = F.split(format_, "[0-9]", -1)
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.substring(digits, i, F.lit(1)), p))), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum of digits whose last one is the check digit."""
    double = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 1, double(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def with_luhn(body: Column) -> Column:
    """The digits with the check digit behind them."""
    return F.concat(body, F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))


def mod97(text: Column) -> Column:
    """The number that digits and letters (A = 10 to Z = 35) spell, modulo 97."""
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def is_account(bare: Column) -> Column:
    return F.length(bare).between(15, 34) & (mod97(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))) == 1)


def _day(m: Column) -> Column:
    """Days since 1900-01-01 of a date in one of the formats; null if the calendar has no such day."""
    iso = F.when(m.rlike("-"), m).when(m.rlike("/"), F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2))).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    n = F.unix_date(iso.try_cast("date")) + 25567
    return F.when((n >= 0) & (n < DAYS[0] * DAYS[1]), n)


def _dated(day: Column, m: Column) -> Column:
    d = F.date_from_unix_date(day.cast("int") - 25567)
    return F.when(m.rlike("-"), F.date_format(d, "yyyy-MM-dd")).when(m.rlike("/"), F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "dd.MM.yyyy"))


def classify(m: Column) -> Column:
    """The kind of a candidate; null if it does not validate."""
    digits = only_digits(m)
    bare = F.regexp_replace(m, " ", "")
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(f"^{OCTET}(?:[.]{OCTET}){{3}}$"), "ip")
        .when(m.rlike("^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\\1[0-9]{4})$"), F.when(_day(m).isNotNull(), "date"))
        .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.when(m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"), "ssn"))
        .when(m.startswith("+"), F.when(F.length(digits).between(8, 15), "phone"))
        .when(m.rlike("^(?:[(][0-9]{3}[)] ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}$"), "phone")
        .when(m.rlike("^[A-Z]{2}[0-9]{2}"), F.when(is_account(bare), "iban"))
        .when(m.rlike("^[0-9A-Fa-f]{32,}$"), "secret")
        .when(F.length(digits).between(13, 19), F.when(luhn_sum(digits) % 10 == 0, "card"))
    )


def part(s: Column, k: Column) -> Column:
    return F.struct(s.alias("s"), k.cast("string").alias("k"))


def parts(m: Column) -> Column:
    """array of struct(s, k): a candidate and its kind; a run of digit groups that is no card as a whole is cut, so that
    from the left the longest span of whole groups that validates is a card. A candidate for an account number that is
    none is cut behind its longest span of groups that is one, or else behind its first group."""

    def account(words: Column) -> Column:
        join = lambda i, n: F.array_join(F.slice(words, i, n), " ")
        sizes = F.sequence(F.size(words) - 1, F.lit(1), F.lit(-1))
        longest = F.get(F.filter(sizes, lambda n: is_account(F.array_join(F.slice(words, 1, n), ""))), F.lit(0))

        def cut(n: Column) -> Column:
            at = F.coalesce(n, F.lit(1))
            head = F.array(part(join(F.lit(1), at), F.when(n.isNotNull(), "iban")), part(F.lit(" "), F.lit(None)))
            return F.concat(head, numbers(join(at + 1, F.size(words))))

        return _let(longest, cut)

    shaped = m.rlike("^[A-Z]{2}[0-9]{2}.* ")
    return F.when(shaped & classify(m).isNull(), _let(F.split(m, " "), account)).otherwise(numbers(m))


def numbers(m: Column) -> Column:
    """The parts of a candidate that is no account number."""
    groups = F.regexp_extract_all(m, F.lit("[ -]?[0-9]+"), F.lit(0))

    def longest(g: Column, i: Column) -> Column:
        """Number of groups of the longest card that starts at group i (from 0); null if there is none."""
        span = lambda n: only_digits(F.array_join(F.slice(g, i + 1, n), ""))
        sizes = F.sequence(F.least(F.lit(19), F.size(g) - i), F.lit(1), F.lit(-1))
        valid = lambda d: F.length(d).between(13, 19) & (F.when(F.length(d).between(13, 19), luhn_sum(d) % 10).otherwise(1) == 0)
        return F.get(F.filter(sizes, lambda n: F.exists(F.array(span(n)), valid)), F.lit(0))

    def cut(g: Column) -> Column:
        start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<s:string,k:string>>").alias("out"))

        def step(a: Column, i: Column) -> Column:
            def put(n: Column) -> Column:
                text = F.array_join(F.slice(g, i + 1, F.coalesce(n, F.lit(1))), "")
                lead = F.regexp_extract(text, "^[ -]?", 0)
                some = F.when(n.isNull(), F.array(part(text, F.lit(None)))).otherwise(F.array(part(lead, F.lit(None)), part(F.substring(text, F.length(lead) + 1, F.length(text)), F.lit("card"))))
                return F.struct((i + F.coalesce(n, F.lit(1))).alias("next"), F.concat(a["out"], some).alias("out"))

            return F.when(i < a["next"], a).otherwise(_let(longest(g, i), put))

        return F.aggregate(F.sequence(F.lit(0), F.size(g) - 1), start, step)["out"]

    run = m.rlike("^[0-9]+(?:[ -][0-9]+)++$") & (F.length(only_digits(m)) >= 13)
    return _let(classify(m), lambda k: F.when(k.isNull() & run, _let(groups, cut)).otherwise(F.array(part(m, k))))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The value of the same kind and format that the key puts in the place of m."""
    digits = only_digits(m)
    n = F.length(digits)
    card = put_digits(m, with_luhn(permute_digits(F.substring(digits, F.lit(1), n - 1), key, "card")))
    code = F.when(m.startswith("+"), F.length(F.regexp_extract(m, "^[+]([0-9]{1,3}?)(?=[^0-9]|[0-9]{7,12}$)", 1))).otherwise(0)
    phone = put_digits(m, F.concat(F.substring(digits, F.lit(1), code), permute_digits(F.substring(digits, code + 1, n), key, "phone")))
    area = _long(F.substring(digits, 1, 3))
    ssn = _let(
        feistel(area - F.when(area > 666, 2).otherwise(1), (_long(F.substring(digits, 4, 2)) - 1) * 9999 + _long(F.substring(digits, 6, 4)) - 1, F.lit(898), F.lit(99 * 9999), key, "ssn"),
        lambda f: F.concat_ws("-", F.lpad((f["l"] + F.when(f["l"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"), F.lpad((F.floor(f["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((f["r"] % 9999 + 1).cast("string"), 4, "0")),
    )
    octet = lambda k: _long(F.split(m, "[.]")[k])
    ip = _let(
        feistel(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), F.lit(65536), F.lit(65536), key, "ip"),
        lambda f: F.concat_ws(".", *[x.cast("string") for s in ("l", "r") for x in (F.floor(f[s] / 256), f[s] % 256)]),
    )
    day = _long(_day(m))
    date = _let(feistel(F.floor(day / DAYS[1]), day % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, "date"), lambda f: _dated(f["l"] * DAYS[1] + f["r"], m))
    local = F.substring_index(m, "@", 1)
    email = _let(permute_text(F.lower(local), key, "email"), lambda p: F.concat(_cased(local, p), F.lit("@"), F.substring_index(m, "@", -1)))
    bare = F.regexp_replace(m, " ", "")
    account = F.substring(bare, F.lit(5), F.length(bare))
    iban = _let(
        permute_text(account, key, "iban", lower="", upper=""),
        lambda a: _spaced(m, F.concat(F.substring(bare, 1, 2), F.lpad((98 - mod97(F.concat(a, F.substring(bare, 1, 2), F.lit("00")))).cast("string"), 2, "0"), a)),
    )
    secret = _let(permute_text(F.lower(m), key, "secret", digits="0123456789abcdef", lower="", upper=""), lambda p: F.when(m == F.upper(m), F.upper(p)).otherwise(p))
    by_kind = {"card": card, "phone": phone, "ssn": ssn, "ip": ip, "date": date, "email": email, "iban": iban, "secret": secret}
    return F.coalesce(*[F.when(kind == k, v) for k, v in by_kind.items()], m)


def _cased(model: Column, text: Column) -> Column:
    """The text with capital letters where the model has them."""
    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c, i: F.when(F.substring(model, i + 1, F.lit(1)).rlike("[A-Z]"), F.upper(c)).otherwise(c)), "")


def _spaced(model: Column, text: Column) -> Column:
    """The text with spaces where the model has them."""
    pieces = F.split(model, " ", -1)
    sizes = F.transform(pieces, lambda p: F.length(p))
    start = lambda i: F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda a, x: a + x)
    return F.array_join(F.transform(pieces, lambda p, i: F.substring(text, F.when(i == 0, 0).otherwise(start(F.greatest(i, F.lit(1)))) + 1, F.length(p))), " ")


def pseudonymise(docs: DataFrame, key: str, text: str = "text", out: str | None = None, counts: bool = True) -> DataFrame:
    """docs with pseudonyms in `out` (the text column itself by default) and, if asked for, n_<kind> for every kind."""
    out = out or text
    numbered = [f"n_{k}" for k in KINDS] if counts else []
    names = {k: fresh(f"_{k}", docs.columns) for k in ("found", "parts", "kinds", "new")}
    whole = F.col(quoted(text))
    may = whole.rlike("[0-9@]|[A-Fa-f]{32}")
    some = docs.withColumn(names["found"], F.when(may, F.regexp_extract_all(whole, F.lit(PATTERN), F.lit(0))))
    told = some.withColumn(names["parts"], F.when(F.size(names["found"]) > 0, F.transform(names["found"], parts)))
    told = told.withColumn(names["kinds"], F.transform(F.flatten(names["parts"]), lambda p: p["k"]))
    hit = F.exists(names["kinds"], lambda k: k.isNotNull())
    new = F.transform(names["parts"], lambda ps: F.array_join(F.transform(ps, lambda p: F.when(p["k"].isNull(), p["s"]).otherwise(pseudonym(p["s"], p["k"], key))), ""))
    pieces = F.split(whole, PATTERN, -1)
    joined = _let(
        F.struct(pieces.alias("p"), new.alias("n")),
        lambda s: F.array_join(F.flatten(F.transform(s["p"], lambda p, i: F.when(i == 0, F.array(p)).otherwise(F.array(s["n"][i - 1], p)))), ""),
    )
    told = told.withColumn(names["new"], F.when(hit, joined).otherwise(whole))
    own = [c for c in docs.columns if c.lower() not in {n.lower() for n in numbered}]
    kept = [F.col(quoted(c)) if c != out else F.col(names["new"]).alias(c) for c in own]
    if out not in own:
        kept.append(F.col(names["new"]).alias(out))
    number = lambda k: F.coalesce(F.size(F.filter(names["kinds"], lambda x: x == k)), F.lit(0)).cast("long").alias(f"n_{k}")
    return told.select(*kept, *[number(k) for k in KINDS if counts])


#: Only for tests and this repository's queries; production passes its own secret.
KEY = "kinelake-public-demonstration-key"


def op1_pii_feistel(spark, sf_dir: str) -> DataFrame:
    from kinelake.llm.store import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = [F.col(f"n_{k}") for k in KINDS]
    return pseudonymise(docs, KEY).withColumn("n_replaced", reduce(lambda a, b: a + b, n))
