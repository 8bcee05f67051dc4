"""Secret scans with an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger holds, per
blob, the rule versions it was scanned with and what they found. A run scans only the (blob,
rule version) pairs the ledger lacks, one copy of each blob however many paths hold it, and
joins the findings back to all paths.

Defined cases: a null text is the empty blob; equal texts share one scan, and repeated rows
each get its findings; null ids stay null; an empty table gives an empty result. Only the
named columns are read, so extra names cannot clash. Very long texts are scanned whole, once per
blob. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A changed pattern needs a new version.

    ``least`` is the length that ``group`` of a match must have; shorter matches are dropped
    but still use up their text. ``needs``: a match holds one of these, compared in lower case.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII
    needs: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Base rules first; among spans with the same start, earlier kinds come first.
RULES = (
    Rule("assign", 1, ASSIGN, 2, 6, re.ASCII | re.IGNORECASE, ("passw", "secret", "token", "api")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, needs=("akia",)),
    # Runs of hex digits are maximal, so the length can stand in the pattern.
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", needs=("gh",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", needs=("eyj",)),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", needs=("-----begin",)),
)
BASE = 3
SPAN = "struct<start:long,kind_no:int,stop:long,kind:string,version:int>"
LEDGER = f"blob_id binary, rules array<string>, spans array<{SPAN}>"


def spans_of(text: str, rules) -> list[dict]:
    low, found = text.lower(), []
    for number, rule, pattern in rules:
        if rule.needs and not any(x in low for x in rule.needs):
            continue
        for m in pattern.finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append(
                    {"start": m.start(), "kind_no": number, "stop": m.end(), "kind": rule.kind, "version": rule.version}
                )
    return found


def addressed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Path, blob address and text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(whole.cast("binary"), 256)).alias("blob_id"), whole.alias("text")
    )


def scan_unseen(paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the pairs of blob and rule version that ``ledger`` lacks.

    Append the result to the ledger. One path stands for each blob; the join that picks
    its text is on blob and path, so a blob with many copies is no hot key.
    """
    names = F.array(*[F.lit(r.name) for r in rules])
    blobs = paths.groupBy("blob_id").agg(F.min("doc_id").alias("first_id"))
    if ledger is None:
        due = blobs.withColumn("due", names)
    else:
        seen = ledger.select("blob_id", F.explode("rules").alias("rule")).groupBy("blob_id")
        done = seen.agg(F.collect_set("rule").alias("done"))
        lacks = F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
        due = blobs.join(done, "blob_id", "left").withColumn("due", lacks).drop("done").where(F.size("due") > 0)
    due = due.withColumnRenamed("blob_id", "due_id").hint("shuffle_hash")
    texts = paths.join(
        due, (F.col("blob_id") == F.col("due_id")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    ).select("blob_id", "due", "text")
    compiled = [(k, r, re.compile(r.pattern, r.flags)) for k, r in enumerate(rules)]
    out = pa.schema(
        [
            ("blob_id", pa.binary()),
            ("rules", pa.list_(pa.string())),
            (
                "spans",
                pa.list_(
                    pa.struct(
                        [
                            ("start", pa.int64()),
                            ("kind_no", pa.int32()),
                            ("stop", pa.int64()),
                            ("kind", pa.string()),
                            ("version", pa.int32()),
                        ]
                    )
                ),
            ),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            due_lists = batch.column(1).to_pylist()
            found = [
                spans_of(text.as_py(), [x for x in compiled if x[1].name in wanted])
                for text, wanted in zip(batch.column(2), due_lists)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, out.field(2).type)], schema=out)

    # A path given twice with the same text has been scanned twice; one row stays.
    return texts.mapInArrow(scan, LEDGER).dropDuplicates(["blob_id"])


def current_spans(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """The spans that these versions of the rules found, by start, then by the rules' order.

    The number of a kind is its place among ``rules``, whatever it was when the blob was scanned.
    """
    places = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))])
    name = lambda s: F.concat_ws(":", s["kind"], s["version"].cast("string"))
    known = F.transform(spans, lambda s: s.withField("kind_no", places[name(s)]))
    return F.sort_array(F.filter(known, lambda s: s["kind_no"].isNotNull()))


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every path with the spans the ledger has for its text from the given rule versions.

    What an older version of a rule found, or a rule that is no longer there, does not count.
    """
    per_blob = ledger.where(F.size("spans") > 0).groupBy("blob_id").agg(
        current_spans(F.flatten(F.collect_list("spans")), rules).alias("spans")
    )
    none = F.array().cast(f"array<{SPAN}>")
    return (
        paths.select("doc_id", "blob_id")
        .join(per_blob, "blob_id", "left")
        .withColumn("spans", F.coalesce("spans", none))
    )


def redacted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, every column kept, each secret replaced by its kind in angle brackets.

    Spans that overlap become one, named after the first. Null texts become empty.
    """
    ledger = scan_unseen(addressed(docs, doc_id, text)).where(F.size("spans") > 0).select("blob_id", "spans")
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.unhex(F.sha2(whole.cast("binary"), 256)).alias("blob_id"))
    met = rows.join(ledger, "blob_id", "left").select("row", F.coalesce(F.col("row")[text], F.lit("")).alias("text"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_without(t, s) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "clean"])

    cut = met.mapInArrow(run, met.select("row").schema.add("clean", "string"))
    quoted = lambda c: "row.`" + c.replace("`", "``") + "`"
    return cut.select([F.col("clean").alias(c) if c == text else F.col(quoted(c)) for c in docs.columns])


def _without(text: str, spans: list[dict] | None) -> str:
    out, at = [], 0
    for s in sorted(spans or [], key=lambda s: (s["start"], s["kind_no"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{s['kind']}>"]
        at = max(at, s["stop"])
    return "".join([*out, text[at:]])


def joined(spans: Column) -> Column:
    part = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, part), ",")


def op4_secret_ledger(spark, sf: str) -> DataFrame:
    paths = addressed(spark.read.parquet(f"{sf}/documents.parquet"))
    found = findings(paths, scan_unseen(paths))
    base = F.filter("spans", lambda s: s["kind_no"] < BASE)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
