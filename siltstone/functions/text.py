"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends; ``trim`` takes spaces only."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def or_else(a: Column, b: Column) -> Column:
    """a unless it is null or empty, else b."""
    return F.coalesce(F.nullif(a, F.lit("")), b)


def blank(c: Column) -> Column:
    return F.coalesce(~c.rlike(r"\S"), F.lit(True))


def words(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def tokens(c: Column) -> Column:
    """Runs without white space."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def token_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\S+")).cast("long")


def hash32(c: Column) -> Column:
    """The first 32 bits of md5, from 0: a hash that other engines have too."""
    return F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def garble_ratio(c: Column, run: int = 4) -> Column:
    """Share of tokens in runs of at least ``run`` single-character tokens. One pattern matches a whole run; 0 without tokens."""
    runs = F.regexp_extract_all(c, F.lit(rf"(?<!\S)\S(?!\S)(?:\s++\S(?!\S)){{{run - 1},}}+"), F.lit(0))
    n = token_count(c)
    return F.when(n > 0, F.char_length(F.regexp_replace(F.array_join(runs, " "), r"\s+", "")).cast("double") / n).otherwise(0.0)


def overlap_ratio(statement: Column, source: Column) -> Column:
    """Share of the statement's distinct words that the source has; 0 for a statement without words."""
    return overlap_of(F.array_distinct(words(statement)), words(source))


def overlap_of(s: Column, w: Column) -> Column:
    """overlap_ratio of distinct words and the source's words."""
    return F.when(F.size(s) > 0, F.size(F.array_intersect(s, w)).cast("double") / F.size(s)).otherwise(0.0)


def grounded(statement: Column, source: Column, least: float = 0.6) -> Column:
    return overlap_ratio(statement, source) >= least


def yes_no(c: Column) -> Column:
    """The first word yes or no, in lower case; where there is none, the first character of the stripped text."""
    found = F.filter(words(c), lambda w: w.isin("yes", "no"))
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.left(F.lower(strip(c)), F.lit(1)))


def spaced_name(c: Column) -> Column:
    """CamelCase as lower-case words, digits apart."""
    apart = F.regexp_replace(c, r"([A-Za-z])([0-9])", "$1 $2")
    return F.lower(F.trim(F.regexp_replace(apart, "([A-Z])", " $1")))


def model_family(c: Column) -> Column:
    """Of an id the last path segment up to its first hyphen; null for null or empty."""
    return F.when(c != "", F.split_part(F.element_at(F.split(c, "/"), -1), F.lit("-"), F.lit(1)))


def without_overlap(text: Column, overlap_tokens: Column) -> Column:
    """Text after its first blank line where a chunk begins with the end of the one before."""
    body = F.substring(text, F.instr(text, "\n\n") + 2, F.char_length(text))
    return F.when((overlap_tokens > 0) & (F.instr(text, "\n\n") > 0), body).otherwise(text)


def normal_title(c: Column) -> Column:
    """Lower case, letters and digits only, single spaces."""
    return F.array_join(words(c), " ")


def rounded(c: Column, places: int) -> Column:
    """Half up by the same floating-point steps in any engine."""
    k = float(10**places)
    return F.floor(c * k + 0.5) / k


def word_shingles(c: Column, k: int = 3) -> Column:
    """Sorted distinct hashes of the runs of k words; of all words as one if there are fewer; empty without words."""
    # The words are bound as the element of a one-element array: a lambda would otherwise find them anew for each place.
    # Words are taken one by one, as slice() copies its whole input there.
    def runs(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0)))
        return F.when(F.size(w) > 0, F.array_sort(F.array_distinct(F.transform(at, lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k))))))).otherwise(F.array().cast("array<bigint>"))

    return F.transform(F.array(words(c)), runs)[0]


def license_family(c: Column) -> Column:
    """A licence id without its version."""
    return F.regexp_replace(c, r"-[0-9]+(\.[0-9]+)*$", "")


#: Licence families that may be published and those that need a look (fixed values).
ALLOW, FLAG = ("CC0", "CC-BY", "public-domain"), ("CC-BY-SA",)


def license_verdict(c: Column, allow: tuple[str, ...] = ALLOW, flag: tuple[str, ...] = FLAG) -> Column:
    family = license_family(c)
    return F.when(F.coalesce(c, F.lit("")) == "", "UNKNOWN").when(family.isin(*allow), "ALLOWED").when(family.isin(*flag), "FLAGGED").otherwise("REJECTED")


def split_of(doc_id: Column, eval_percent: int = 10) -> Column:
    """train or eval by document, the same on each run."""
    return F.when(hash32(doc_id) % 100 < eval_percent, "eval").otherwise("train")
