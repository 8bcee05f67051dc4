"""Quality rules as a bitmask ledger: measure once, judge by versioned policies.

``measure`` evaluates every rule's measurement once per document, ``ledger`` turns the
measurements into one integer of failure bits, ``apply_policy`` keeps or rejects by a mask
over those bits, and ``ablate`` counts, from the distinct bit patterns alone, what each rule
and each rule's removal does. A new policy reads the ledger, never the texts.

Defined cases: a null or empty text has no words and fails ``few_words``; repeated rows are
judged alike, each on its own; an empty table gives an empty result; columns that are not
named in the arguments are never read, so their names cannot clash. Null ids stay null. Very
long texts are measured whole, one row at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A named failure test over the measurements. Its bit is its place in the ledger."""

    name: str
    fails: str


#: Bits 0 and 1 are the base rules. Limits are integers, so no rule depends on rounding.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * word_chars"),
    Rule("repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
)
BASE = ("few_words", "repeated_words")
#: A policy is the set of rules that reject. Versions are never changed, only added.
POLICIES = {1: BASE, 2: tuple(r.name for r in RULES)}


def _words(text: Column) -> Column:
    plain = F.translate(text, SPACES, " " * len(SPACES))
    return F.filter(F.split(plain, " +"), lambda w: w != "")


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_row: bool = False) -> DataFrame:
    """One row per document: its id and the measurements of every rule.

    ``with_row`` puts the whole input row, as a struct, under ``row``.

    Words are runs of anything but the six ASCII white-space characters. ``n_repeat_words``
    counts the words inside five-word windows that occur twice or more, by sorting the
    windows' 64-bit hashes; texts whose hashes are all different skip the sort.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    row = ["row"] if with_row else []
    worded = docs.select(
        *[F.struct("*").alias("row") for _ in row],
        F.col(doc_id).alias("doc_id"),
        _words(whole).alias("words"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    words, hashes, order = F.col("words"), F.col("hashes"), F.col("order")
    hashed = worded.select(
        *row,
        "doc_id",
        "word_chars",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") > WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - WINDOW),
                lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
            ),
        ).alias("hashes"),
    )
    ordered = hashed.withColumn(
        "order",
        F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    starts = F.sort_array(
        F.transform(
            F.filter(
                order,
                lambda x, i: (x["h"] == F.get(order, i - 1)["h"]) | (x["h"] == F.get(order, i + 1)["h"]),
            ),
            lambda x: x["i"],
        )
    )
    found = ordered.withColumn("starts", starts)
    gaps = F.zip_with(
        F.col("starts"),
        F.slice(F.col("starts"), 2, F.size("starts")),
        lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))),
    )
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select(
        *row,
        "doc_id",
        *[m for m in MEASURES if m != "n_repeat_words"],
        F.when(F.col("starts").isNull(), F.lit(0).cast("long")).otherwise(covered).alias("n_repeat_words"),
    )


def ledger(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measurements with ``fail_bits``: bit k is set where rule k fails."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def mask_of(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    at = {r.name: k for k, r in enumerate(rules)}
    return sum(1 << at[name] for name in names)


def apply_policy(bits: DataFrame, version: int) -> DataFrame:
    """The ledger with ``policy`` and ``kept``: no bit of the policy's mask is set."""
    mask = F.lit(mask_of(POLICIES[version])).cast("long")
    return bits.withColumns({"policy": F.lit(version), "kept": F.col("fail_bits").bitwiseAND(mask) == 0})


def kept_rows(docs: DataFrame, version: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents a policy keeps, all columns as they are.

    A filter on the verdict alone would be pushed below the measurements, each then worked
    out once per use. A row number beside the verdict holds the filter above them.
    """
    judged = apply_policy(ledger(measure(docs, doc_id, text, with_row=True)), version)
    numbered = judged.select("row", "kept", F.monotonically_increasing_id().alias("row_no"))
    kept = numbered.where(F.col("kept") & (F.col("row_no") >= 0))
    return kept.select([F.col("row.`" + c.replace("`", "``") + "`") for c in docs.columns])


def ablate(bits: DataFrame, version: int, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of a policy: documents it fails, fails alone, and keeps when left out.

    Works on counts of distinct bit patterns, at most 2 to the number of rules.
    """
    names = POLICIES[version]
    mask = mask_of(names, rules)
    patterns = bits.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(
        F.count("*").alias("n")
    )
    table = F.array(
        *[
            F.struct(F.lit(n).alias("rule"), F.lit(mask_of([n], rules)).cast("long").alias("bit"))
            for n in names
        ]
    )
    each = patterns.select("bits", "n", F.inline(table))
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return each.groupBy("rule").agg(
        total(fails).alias("n_failed"),
        total(alone).alias("n_failed_alone"),
        total((F.col("bits") == 0) | alone).alias("n_kept_without"),
    )


def op5_quality_rules(spark, sf: str) -> DataFrame:
    judged = apply_policy(ledger(measure(spark.read.parquet(f"{sf}/documents.parquet"))), max(POLICIES))
    base = F.lit(mask_of(BASE)).cast("long")
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"),
        "kept",
        "fail_bits",
    )


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
h AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS s FROM g),
p AS (SELECT r, i FROM h QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
c AS (SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS n FROM p),
s AS (SELECT r, sum(n)::BIGINT AS n_repeat_words FROM c GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
  length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
  len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN s USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
  + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
  + CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END
  + CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END
  + CASE WHEN 100 * n_symbols > 10 * word_chars THEN 16 ELSE 0 END
  + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""
