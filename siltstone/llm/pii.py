"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score. DataFrame functions only.

Four base kinds (email, ip, card, phone) always stand when their check passes. Two further kinds need a
score: IBANs, confirmed by mod-97, and national identity numbers, which context words must support.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters on either side of a span in which context words count, what such a word adds, and the least score of a further kind.
CONTEXT_CHARS, CONTEXT_BONUS, LEAST_SCORE = 40, 0.35, 0.6
#: Matches that are placed together.
GROUP = 128


@dataclass(frozen=True)
class Kind:
    """start: what must stand before a match, so that a failing run of characters is tried once only.
    body: the pattern, possessive where what follows can't begin with the same characters. need: a plain
    pattern that any text with a match has; other texts aren't walked."""

    name: str
    start: str
    body: str
    need: str
    base: float
    context: str


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))", r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@[A-Za-z0-9-]", 0.9, r"(?i)\b(?:e-?mail|mail|contact|write)\b"),
    Kind("ip", r"(?:\G|(?<![0-9]))", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.7, r"(?i)\b(?:ip|host|server|address)\b"),
    Kind("card", "", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", 0.8, r"(?i)\b(?:card|visa|credit|payment)\b"),
    Kind("phone", "", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, r"(?i)\b(?:phone|tel|call|fax|mobile)\b"),
    Kind("iban", r"(?<![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", 0.7, r"(?i)\b(?:iban|account|bank|konto)\b"),
    Kind("national_id", r"(?<![0-9-])", r"(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", 0.3, r"(?i)\b(?:ssn|social security|identity)\b"),
)
BASE = tuple(k.name for k in KINDS[:4])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The sum of the digits, each second one from the right doubled and its digits summed, ends in 0."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2 / 10).cast("int") + d.cast("int") * 2 % 10))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(code: Column) -> Column:
    """An IBAN with its first four characters at the end, letters as 10 to 35, leaves 1 over 97."""
    plain = F.regexp_replace(code, " ", "")
    turned = F.split(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)), "")
    value = F.transform(turned, lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    return F.aggregate(value, F.lit(0), lambda a, x: F.when(x < 10, a * 10 + x).otherwise(a * 100 + x) % 97) == 1


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (p == "") | ((F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255)))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return mod97(m) if kind == "iban" else F.lit(True)


def _matches(text: Column, kind: Kind) -> Column:
    r"""Array of (start, end, match, before, after): leftmost matches that don't overlap, and what stands next to them, up to the
    neighbouring matches. Each step of the pattern takes what lies before a match with it, and \G lets it begin only where
    the last step ended, so a text is walked once for each of the two groups."""
    step = rf"\G((?s:.*?))({kind.start}{kind.body})"
    found = F.struct(*(F.regexp_extract_all(text, F.lit(step), F.lit(i)).alias(n) for i, n in ((1, "before"), (2, "match"))))
    none = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")
    size = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + F.char_length(x))

    def add(a: Column, x: Column) -> Column:
        start = a["at"] + F.char_length(x["before"])
        end = start + F.char_length(x["match"])
        row = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), F.substring(x["before"], -CONTEXT_CHARS, CONTEXT_CHARS).alias("before"), F.substring(x["after"], 1, CONTEXT_CHARS).alias("after"))
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(row)).alias("out"))

    def placed(groups: Column) -> Column:
        """Places within each group from where it starts: appending all matches to one array would copy it for each match."""
        long = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda a, x: a + F.char_length(x["before"]) + F.char_length(x["match"])))
        begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(long, begun, lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(groups, starts, lambda g, at: F.aggregate(g, F.struct(at.alias("at"), none.alias("out")), add, lambda a: a["out"])))

    def listed(f: Column) -> Column:
        before, match = f["before"], f["match"]
        rest = F.substring(text, size(before) + size(match) + 1, F.lit(CONTEXT_CHARS))
        after = F.concat(F.slice(before, F.lit(2), F.size(before)), F.array(rest))
        pairs = F.zip_with(before, match, lambda b, m: F.struct(b.alias("before"), m.alias("match")))
        triples = F.zip_with(pairs, after, lambda p, n: F.struct(p["before"].alias("before"), p["match"].alias("match"), n.alias("after")))
        cut = lambda t: F.transform(F.sequence(F.lit(0), F.floor((F.size(t) - 1) / GROUP).cast("int")), lambda i: F.slice(t, i * GROUP + 1, F.lit(GROUP)))
        groups = F.transform(F.array(triples), cut)[0]
        return F.when(F.size(match) > 0, F.transform(F.array(groups), placed)[0]).otherwise(none)

    # Bound as the element of a one-element array, so that the text is walked once however often the matches are named.
    return F.when(text.rlike(kind.need), F.transform(F.array(found), listed)[0]).otherwise(none)


def pii_spans(docs: DataFrame) -> DataFrame:
    """docs with personal_data: array of (start, ord, end, kind, score, base) by start, then kind. Places count code points, end exclusive.
    A null text is empty and has none. Other columns pass through; a column named personal_data is replaced."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("personal_data", F.array_sort(F.concat(*(_spans_of(text, i, k) for i, k in enumerate(KINDS)))))


def _spans_of(text: Column, place: int, kind: Kind) -> Column:
    def span(x: Column) -> Column:
        score = F.lit(kind.base) + F.when(x["before"].rlike(kind.context) | x["after"].rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(x["start"].alias("start"), F.lit(place).alias("ord"), x["end"].alias("end"), F.lit(kind.name).alias("kind"), F.least(score, F.lit(1.0)).alias("score"), F.lit(kind.name in BASE).alias("base"))

    good = F.filter(_matches(text, kind), lambda x: _confirmed(kind.name, x["match"]))
    return F.filter(F.transform(good, span), lambda s: s["base"] | (s["score"] >= LEAST_SCORE))


def _count_of(kind: str) -> Column:
    return F.size(F.filter("p", lambda s: s["kind"] == kind)).cast("long")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, max_score (null without spans).
    Rows that repeat count each; an empty table gives an empty result."""
    p = pii_spans(docs.select("doc_id", "text")).select("doc_id", F.col("personal_data").alias("p"))
    counts = [_count_of(k).alias(f"n_{k}") for k in BASE]
    base = F.filter("p", lambda s: s["base"])
    return p.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("p")).alias("spans"), F.array_max(F.transform("p", lambda s: s["score"])).alias("max_score"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with each span of personal data in text replaced by its kind in brackets. A span that overlaps an earlier one is covered by
    that; what of it goes on beyond is left out too. A null text stays null."""
    spans = pii_spans(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(a: Column, s: Column) -> Column:
        gap = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        return F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("at"), F.concat(a["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out")))

    done = F.aggregate("personal_data", zero, put, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))
    return spans.withColumn("text", F.when(F.col("text").isNotNull(), done))
