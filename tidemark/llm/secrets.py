"""Secret scans with an incremental ledger of content-addressed texts."""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as T
from tidemark.sources.storage import exists, scratch_path


@dataclass(frozen=True)
class Rule:
    """Spans of a pattern whose ``group`` has ``least`` characters; failing matches are dropped.

    Matches are leftmost and do not overlap within the rule. A text without any
    of ``needs`` (lowered ASCII) cannot match, which saves the search.
    """

    kind: str
    pattern: str
    needs: tuple[str, ...]
    group: int = 0
    least: int = 1
    any_case: bool = False


# A private key runs to its END line. Where another block begins or ends before that, or the text is cut
# short, it runs over its header lines and its key lines: words of 16 base64 characters or more, and
# shorter ones alone on a line. Lines may be quoted, or broken by the two characters of an escape.
_LINE_END = r"""(?:[\x20\t"',;+]*(?:[\r\n]|\\[nr]))"""
_GAP = r"""(?:[\s>#*|"',;]|\\[nrt])*+"""
_PEM = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:"
    r"(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]*PRIVATE KEY-----|"
    rf"(?:{_LINE_END}{_GAP}[A-Za-z][A-Za-z0-9-]*:(?:(?!\\[nr])[^\r\n])*+|{_GAP}(?:Proc-Type|DEK-Info):\x20*[^\s\\]++)*+"
    rf"(?:{_GAP}[A-Za-z0-9+/]{{16,}}+={{0,2}}|{_LINE_END}{_GAP}[A-Za-z0-9+/]++={{0,2}}(?={_LINE_END}|[\x20\t\"',;]*\Z))*+)"
)

# The first three patterns and their least lengths. Spans sort in the order of the kinds.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        group=2,
        least=6,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", ("akia",), least=20),
    Rule("hex", r"[0-9a-f]+", (), least=24),
    Rule("bearer", r"Bearer\x20+[A-Za-z0-9._~+/-]{16,}", ("bearer",)),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+", ("eyj",)),
    Rule("pem", _PEM, ("private key",)),
    Rule("prefixed", r"(?:gh[pousr]_|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16,}", ("gh", "xox", "sk_live_", "aiza")),
    Rule("url", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]++:[^\s/:@]{4,}+@", ("://",)),
)

_HEX = bytes(ord("x") if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_SPANS = "array<struct<kind:string,start:int,end:int>>"


def rule_version(rules=RULES) -> str:
    """Changes with any rule, so a changed rule set scans every text anew."""
    return hashlib.sha256(repr(tuple(rules)).encode()).hexdigest()[:16]


class Scanner:
    def __init__(self, rules=RULES):
        self.rules = [
            (at, r, re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)),
             [n.encode() for n in r.needs])
            for at, r in enumerate(rules)
        ]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then by the order of the rules."""
        data = text.encode()
        low = data.translate(T.LOWER)
        found = []
        for at, rule, pattern, needs in self.rules:
            if needs:
                if not any(n in low for n in needs):
                    continue
            elif rule.pattern == "[0-9a-f]+" and b"x" * rule.least not in data.translate(_HEX):
                continue
            for m in pattern.finditer(text):
                s, e = m.span(rule.group)
                if e - s >= rule.least:
                    found.append((m.start(), at, rule.kind, m.end()))
        return [(kind, s, e) for s, _, kind, e in sorted(found)]


class Ledger:
    """Texts by the SHA-256 of their UTF-8, and findings by text and rule version.

    ``root/versions`` holds (blob, path) of every text ever shown, one folder
    per increment, ``root/blobs`` one text per blob, and ``root/findings`` the
    spans of every blob scanned, by rule version. All only grow. An increment
    that fails leaves folders that Spark's writer did not commit, or texts
    without findings; either is made good by the next one.

    ``keep=False`` stores no texts: for a ledger that is used once, as blobs of
    earlier increments are then not scanned under new rules.
    """

    def __init__(self, spark, root: str | None = None, rules=RULES, keep: bool = True):
        self.spark, self.rules, self.keep = spark, tuple(rules), keep
        self.root = (root or scratch_path(spark, "secret-ledger")).rstrip("/")
        self.version = rule_version(rules)
        self.findings_path = f"{self.root}/findings/{self.version}"

    def _read(self, path: str, schema: str) -> DataFrame:
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def findings(self) -> DataFrame:
        """``blob`` and ``spans`` of everything scanned under this rule version."""
        return self._read(self.findings_path, f"blob string, spans {_SPANS}")

    def blobs(self) -> DataFrame:
        """``blob`` and ``text`` of every text ever shown, each once."""
        # Rows that repeat path and text are kept as often as they came in one increment.
        return self._read(f"{self.root}/blobs", "blob string, text string").dropDuplicates(["blob"])

    def versions(self) -> DataFrame:
        """``path`` and ``blob`` of every text that any path ever had, each pair once."""
        return self._read(f"{self.root}/versions", "path bigint, blob string").distinct()

    def history(self) -> DataFrame:
        """``path``, ``blob`` and ``spans`` of every text that any path ever had."""
        return self.spans_of(self.versions())

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Record every text and scan what this rule version has not seen; ``path`` and ``blob`` of the rows given.

        Null texts count as empty; rows with a null id are kept with a null path.
        One row per unseen blob is kept and scanned, however many copies there
        are. Blobs of earlier increments are scanned as well if the rules are new.
        """
        step = uuid.uuid4().hex
        rows = T.narrow(docs, id_col, text_col).withColumn("blob", F.sha2("text", 256))
        at = f"{self.root}/versions/{step}"
        rows.select(F.col("doc_id").alias("path"), "blob").write.parquet(at)
        versions = self.spark.read.parquet(at)
        known = self._read(f"{self.root}/blobs", "blob string") if self.keep else self.findings().select("blob")
        once = versions.groupBy("blob").agg(F.min(T.id_key("path")).alias("key"))
        unseen = once.join(known, "blob", "left_anti")
        texts = rows.withColumn("key", T.id_key("doc_id")).join(unseen, ["blob", "key"], "left_semi")
        texts = texts.select("blob", "text")
        if self.keep:
            texts.write.option("compression", "zstd").parquet(f"{self.root}/blobs/{step}")
            texts = self.blobs().join(self.findings().select("blob"), "blob", "left_anti")
        # Repeated rows share path and blob, so a blob may have been scanned more than once.
        self._scanned(texts).dropDuplicates(["blob"]).write.parquet(f"{self.findings_path}/{step}")
        return versions

    def _scanned(self, texts: DataFrame) -> DataFrame:
        rules = self.rules

        def scan(batches):
            scanner = Scanner(rules)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            for batch in T.slices(batches):
                spans = [
                    [{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(t)]
                    for t in batch.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(spans, kind)], ["blob", "spans"]
                )

        return texts.mapInArrow(scan, f"blob string, spans {_SPANS}")

    def spans_of(self, versions: DataFrame) -> DataFrame:
        """``path``, ``blob`` and ``spans`` (empty where nothing is found) of the rows given."""
        found = self.findings().where(F.size("spans") > 0)
        nothing = F.array().cast(_SPANS)
        return versions.join(found.hint("merge"), "blob", "left").select(
            "path", "blob", F.coalesce("spans", nothing).alias("spans")
        )


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", root: str | None = None, rules=RULES
) -> DataFrame:
    """``path`` (the id), ``blob`` and ``spans`` of every row, through the ledger at ``root``.

    Without ``root`` the ledger is a new one in the session's shared folder that
    keeps no texts, as nobody comes back to it. An empty table gives no rows.
    """
    ledger = Ledger(docs.sparkSession, root, rules, keep=root is not None)
    return ledger.spans_of(ledger.add(docs, id_col, text_col))


def redact(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", root: str | None = None,
    mark: str = "[SECRET]", rules=RULES, length_col: str | None = None,
) -> DataFrame:
    """The rows as they are, with each stretch of spans in the text replaced by ``mark``.

    ``length_col`` gets the new number of code points. Rows without findings are
    untouched, null texts as well. Other columns, whatever their names, and
    repeated rows stay.
    """
    ledger = Ledger(docs.sparkSession, root, rules, keep=root is not None)
    versions = ledger.add(docs, id_col, text_col)
    # Findings are by blob, so one row for each blob with a secret meets the rows.
    found = ledger.findings().where(F.size("spans") > 0)
    found = found.join(versions.select("blob").distinct(), "blob", "left_semi")
    name = "_found"
    while name in docs.columns:
        name = f"_{name}"
    found = found.select(F.struct("blob", "spans").alias(name))
    blob = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    joined = docs.join(found.hint("merge"), blob == F.col(name)["blob"], "left")
    spans = F.col(name)["spans"]

    @F.pandas_udf("string")
    def cut(text, spans):
        return text.combine(spans, lambda t, s: t if s is None else _replace(t, s, mark))

    new = F.when(spans.isNull(), F.col(text_col)).otherwise(cut(F.col(text_col), spans))
    joined = joined.withColumn(text_col, new)
    if length_col:
        kind = joined.schema[length_col].dataType
        size = F.when(spans.isNull(), F.col(length_col)).otherwise(F.length(text_col).cast(kind))
        joined = joined.withColumn(length_col, size)
    return joined.drop(name)


def _replace(text: str, spans, mark: str) -> str:
    out, at = [], 0
    for span in spans:
        if span["start"] >= at:
            out += [text[at : span["start"]], mark]
        at = max(at, span["end"])
    return "".join(out) + text[at:]
