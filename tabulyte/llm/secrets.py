"""Secret scan with multipart credential linking.

Strong patterns are reported wherever they stand.  Weak parts (short key material,
account names, endpoints) are reported only where complementary parts stand close to
each other in one scope: an interval join over position bins links a part of key
material with an access identifier or an endpoint."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulyte.llm.decontaminate import merged
from tabulyte.llm.scratch import kept

# The strong patterns and the least lengths of their matches.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "key", "account", "endpoint")

# Weak parts: named key material shorter than the strong rule asks, account names, endpoints.
# A name may follow an underscore, as in DB_PASSWORD, but no letter or digit.
_NAMED = "(?<![A-Za-z0-9])"
_KEY = re.compile(_NAMED + r"""(?i:password|passwd|pwd|secret(?:_?access)?(?:_?key)?|token|api_?key|auth|private_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""", re.A)
_ACCOUNT = re.compile(_NAMED + r"""(?i:user(?:name)?|login|account|client_?id|(?<!secret_)access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""", re.A)
_URL = r"""[a-z][a-z0-9+]{1,15}://[^\s"'<>]{4,}"""
_ENDPOINT = re.compile(rf"""\b{_URL}|{_NAMED}(?i:host(?:name)?|endpoint|server|url)["']?\x20*[:=]\x20*["']?(?:{_URL}|[A-Za-z0-9][A-Za-z0-9.:/-]{{3,}})""", re.A)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_WEAK_HINTS = ("pwd", "auth", "privatekey", "private_key", *_ASSIGN_HINTS)
#: Parts of one credential lie in one paragraph and at most so many characters apart.
SCOPE = 400

Span = tuple[str, int, int]


def strong_spans(text: str) -> list[Span]:
    """Strong matches by start, then kind as listed; positions in code points."""
    found: list[Span] = []
    lowered = text.lower() if "=" in text or ":" in text else ""
    if any(h in lowered for h in _ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def weak_parts(text: str, strong: list[Span]) -> list[Span]:
    """Weak parts that touch no strong span."""
    if not ("=" in text or ":" in text):
        return []
    lowered = text.lower()
    found: list[Span] = []
    if any(h in lowered for h in _WEAK_HINTS):
        found += [("key", *m.span(1)) for m in _KEY.finditer(text) if re.search(r"[0-9+/_=]", m[1])]
    found += [("account", *m.span()) for m in _ACCOUNT.finditer(text)]
    found += [("endpoint", *m.span()) for m in _ENDPOINT.finditer(text)]
    taken = merged((a, b) for _, a, b in strong)
    ends = [b for _, b in taken]

    def free(a: int, b: int) -> bool:
        after = bisect_right(ends, a)  # the first strong span that ends after a
        return after == len(taken) or taken[after][0] >= b

    return [(k, a, b) for k, a, b in found if free(a, b)]


def with_paragraphs(text: str, parts: list[Span]) -> list[tuple[str, int, int, int]]:
    """Parts with the number of blank lines before them."""
    breaks = [m.end() for m in re.finditer("\n\n", text)] if parts else []
    return [(k, a, b, bisect_right(breaks, a)) for k, a, b in parts]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_PART = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64()), ("strong", pa.bool_())])
_DDL = "struct<kind: string, start: long, end: long>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, parts = [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            strong = strong_spans(text)
            base.append([dict(zip(("kind", "start", "end"), s)) for s in strong])
            weak = weak_parts(text, strong)
            rows = [(*p, False) for p in with_paragraphs(text, weak)] + [(*p, True) for p in with_paragraphs(text, strong if weak else [])]
            parts.append([dict(zip(("kind", "start", "end", "scope", "strong"), r)) for r in rows])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(base, pa.list_(_SPAN)), pa.array(parts, pa.list_(_PART))],
            ["doc_id", "text_hash", "base", "parts"])


def secret_spans(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base (strong spans) and spans (base and confirmed weak
    spans), arrays of kind, start, end in code points, ordered by start and kind.

    A weak part of key material is confirmed by an access identifier, an account name or
    an endpoint that starts at most `scope` characters away in the same paragraph, and
    those weak ones by key material, weak or strong.  Parts inside a strong span are not
    listed again.  Null and empty texts have no spans.  Rows with the same id and text have
    the same spans; repeated rows and null ids are returned as often as they come."""
    text = F.col(text_col)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = kept(docs.mapInArrow(
        _scan, f"doc_id {kind}, text_hash long, base array<{_DDL}>, parts array<struct<kind: string, start: long, end: long, scope: long, strong: boolean>>"), "parts")
    key = ["doc_id", "text_hash"]
    # the key of a document and text once; copies of a row share its parts
    parts = found.filter(F.size("parts") > 1).select(*key, F.explode("parts").alias("p")).select(*key, "p.*").distinct()
    parts = parts.withColumn("role", F.when(F.col("kind").isin("key", "assign", "hex"), "material").otherwise("reference"))
    near = parts.select(
        F.col("doc_id").alias("o_id"), F.col("text_hash").alias("o_hash"), F.col("scope").alias("o_scope"), F.col("role").alias("o_role"), F.col("start").alias("o_start"),
        F.explode(F.array(*[F.floor(F.col("start") / scope) + k for k in (-1, 0, 1)])).alias("o_bin"))
    weak = parts.filter("not strong").withColumn("bin", F.floor(F.col("start") / scope))
    linked = weak.join(
        near,
        F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_hash") == F.col("o_hash")) & (F.col("scope") == F.col("o_scope")) & (F.col("bin") == F.col("o_bin"))
        & (F.col("role") != F.col("o_role")) & (F.abs(F.col("start") - F.col("o_start")) <= scope), "left_semi")
    linked = linked.groupBy(F.col("doc_id").alias("l_id"), F.col("text_hash").alias("l_hash")).agg(F.collect_list(F.struct("kind", "start", "end")).alias("weak"))
    out = found.join(linked, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("text_hash") == F.col("l_hash")), "left")
    rank = F.array(*[F.lit(k) for k in KINDS])
    by = lambda s: F.struct(s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    spans = F.transform(F.array_sort(F.transform(F.concat("base", F.coalesce("weak", F.array().cast(f"array<{_DDL}>"))), by)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select("doc_id", "base", spans.alias("spans"))
