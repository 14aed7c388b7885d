"""Op 11: secret scans with an incremental ledger of blobs.

A history is a table of versions: every row is the whole text of one path at one time. A text is addressed by the
SHA-256 of its bytes, so all versions and paths that hold the same text are one blob. The ledger, an append-only
table, has an entry for each blob that was scanned: the rule versions it was scanned with and what they found. A scan
reads only blobs with a rule version that the ledger does not have for them, runs only those rules, appends the
entries, and joins the findings back to all rows by address.

An entry is a function of its blob and its rules alone. A scan that is run again after a failure, or twice at once,
may append an entry twice, and an entry of a scan that failed later is as good as any other: readers merge them. A
rule's version is a hash of all that decides what it finds, so an edited rule is scanned anew, and findings of old
versions stay in the ledger but are no longer reported.

Copies inside a partition of the input are dropped before texts are shuffled by address, so a blob that a third of all
rows repeat reaches its task once for each partition. Findings come back by a join that adaptive execution may split.

Null counts as the empty text. Rows may repeat or lack a doc_id; each gets a row of the result. Columns other than
the id and the text are ignored. Spans are places of code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import arrow_map, pieces, table, whole_text, written
from .registry import query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost matches that do not overlap, of which those with a long enough group count.

    ``needs`` is a cheap pattern that every text with a match has. ``entropy`` is the least Shannon entropy, in bits a
    character, of the group; 0 asks for none.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = re.ASCII
    needs: str = ""
    entropy: float = 0.0

    @property
    def version(self) -> str:
        fields = (self.kind, self.pattern, self.group, self.least, int(self.flags), self.entropy)
        return f"{self.kind}@{hashlib.sha256(repr(fields).encode()).hexdigest()[:16]}"

    def spans(self, text: str, compiled: re.Pattern) -> list[tuple[int, int]]:
        return [m.span() for m in compiled.finditer(text) if len(m[self.group]) >= self.least and (not self.entropy or bits(m[self.group]) >= self.entropy)]


def bits(text: str) -> float:
    """Shannon entropy of the characters of a text."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values()) if text else 0.0


# fixed values: the base kinds, in the order they are listed
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, re.ASCII | re.IGNORECASE,
         r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, needs=r"AKIA[A-Z0-9]{12}"),
    Rule("hex", r"[0-9a-f]+", 0, 32, needs=r"[0-9a-f]{32}"),
)
#: Kinds that the operator adds: well-known forms of credentials. A match starts where its run of characters does, so
#: that no text is read over and over.
ADDED = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", needs=r"PRIVATE KEY-----"),
    Rule("forge_token", r"(?<![A-Za-z0-9_-])(?:gh[oprsu]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,})", needs=r"(?:gh[oprsu]_|glpat-)"),
    Rule("chat_token", r"(?<![A-Za-z0-9-])xox[abeprs]-[A-Za-z0-9-]{10,}", needs=r"xox[abeprs]-"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs=r"eyJ[A-Za-z0-9_-]+\.eyJ"),
    Rule("url_login", r"://[^\s/:@]{1,256}:([^\s/:@]{3,256})@", 1, 3, needs=r"://[^\s/:@]+:[^\s/:@]+@"),
    Rule("random", r"[A-Za-z0-9+/_-]{40,}={0,2}", 0, 40, needs=r"[A-Za-z0-9+/_-]{40}", entropy=4.5),
)
RULES = BASE + ADDED
#: One entry of the ledger.
ENTRY = "address binary, rules array<string>, findings array<struct<rule:string,first:bigint,last:bigint>>"


def addressed(versions: DataFrame, text: str = "text") -> Column:
    """The content address of a text: the 32 bytes of its SHA-256."""
    return F.unhex(F.sha2(whole_text(text), 256))


def find(text: str, rules: Sequence[Rule] = RULES) -> list[tuple[str, int, int]]:
    """(rule version, start, end) of all findings in one text."""
    return [(r.version, a, b) for r in rules for a, b in r.spans(text, re.compile(r.pattern, r.flags))]


def ledger_entries(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger's entries; None before the first scan."""
    try:
        return spark.read.schema(ENTRY).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def unseen(addresses: DataFrame, entries: DataFrame | None, rules: Sequence[Rule]) -> DataFrame:
    """Blobs with the rule versions that were never run on them (address, todo); those with none left are not in it."""
    wanted = F.array(*[F.lit(r.version) for r in rules])
    blobs = addresses.select("address").distinct()
    if entries is None:
        return blobs.withColumn("todo", wanted)
    # at most one element for each rule version there ever was
    done = entries.groupBy("address").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("_done"))
    todo = F.array_except(wanted, F.coalesce("_done", F.array().cast("array<string>")))
    return blobs.join(done, "address", "left").select("address", todo.alias("todo")).where(F.size("todo") > 0)


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition without those whose address it had before; 32 bytes are kept for each."""
    had: set[bytes] = set()
    for batch in batches:
        keep = []
        for address in batch.column("address").to_pylist():
            keep.append(address not in had)
            had.add(address)
        yield batch.filter(pa.array(keep))


def _scanner(rules: Sequence[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(r, r.version, re.compile(r.pattern, r.flags)) for r in rules]
        kind = pa.list_(pa.struct([("rule", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))
        for batch in pieces(batches):
            texts, todo = batch.column("text"), batch.column("todo").to_pylist()
            found: list[list[dict]] = [[] for _ in todo]
            for rule, version, pattern in compiled:
                may = pc.match_substring_regex(texts, rule.needs) if rule.needs else pc.is_valid(texts)
                for k in pc.indices_nonzero(may).to_pylist():
                    if version in todo[k]:
                        found[k].extend({"rule": version, "first": a, "last": b} for a, b in rule.spans(texts[k].as_py(), pattern))
            yield pa.RecordBatch.from_arrays([batch.column("address"), batch.column("todo"), pa.array(found, kind)], ["address", "rules", "findings"])
    return run


def scan(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Scan what is new in ``versions``, append it to the ledger, and return the addresses that were scanned (address, todo)."""
    spark = versions.sparkSession
    new = written(unseen(versions.select(addressed(versions, text).alias("address")), ledger_entries(spark, ledger), rules), "unseen_blobs")
    if not new.isEmpty():
        blobs = versions.select(addressed(versions, text).alias("address"), whole_text(text).alias("text"))
        blobs = arrow_map(blobs, _first_of_each, "address binary, text string")
        # one text for each address; the join leaves blobs by address, so this takes no further shuffle
        todo = blobs.join(new, "address").dropDuplicates(["address"])
        arrow_map(todo, _scanner(rules), ENTRY).write.mode("append").parquet(ledger)
    return new


def blob_findings(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """address, and the findings of the given rule versions in order of place and rule, for blobs that have any."""
    order = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.version), F.struct(F.lit(k).alias("k"), F.lit(r.kind).alias("kind")))])
    entries = ledger_entries(spark, ledger)
    if entries is None:
        entries = spark.createDataFrame([], ENTRY)
    rows = entries.where(F.size("findings") > 0).select("address", F.explode("findings").alias("f")).where(F.col("f.rule").isin([r.version for r in rules]))
    rows = rows.select("address", F.col("f.first").alias("first"), order[F.col("f.rule")].alias("_o"), F.col("f.last").alias("last"))
    spans = F.array_sort(F.collect_set(F.struct("first", F.col("_o.k").alias("k"), "last", F.col("_o.kind").alias("kind"))))
    return rows.groupBy("address").agg(spans.alias("spans"))


def findings(versions: DataFrame, ledger: str, keys: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The named columns, the address and the spans of every version, findings or not; ``versions`` must be scanned."""
    places = versions.select(*keys, addressed(versions, text).alias("address"))
    return places.join(blob_findings(versions.sparkSession, ledger, rules), "address", "left")


def report(docs: DataFrame, ledger: str) -> DataFrame:
    """One row per row of ``docs``: numbers of base findings, a digest of their places, and all places."""
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    scan(docs, ledger)
    rows = findings(docs, ledger)
    spans = F.coalesce("spans", F.array().cast("array<struct<first:bigint,k:int,last:bigint,kind:string>>"))

    def listed(x: Column) -> Column:
        return F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["last"].cast("string"))), ",")
    base = F.filter(spans, lambda s: s["k"] < len(BASE))
    counts = [F.size(F.filter(spans, lambda s: s["k"] == k)).cast("bigint").alias(f"n_{r.kind}") for k, r in enumerate(BASE)]  # noqa: B023
    return rows.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"))


@query("op11_blob_ledger")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), scratch_dir(spark, "ledger"))
