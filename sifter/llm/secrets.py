"""Secrets in whole texts: fixed patterns, and strings that nothing near them can compress.

Base spans come from three patterns (assignments, access keys, hex runs).  The
method adds to them: a candidate is a run of key characters shortly after a
sensitive word, and its novelty is what it costs zstandard, primed with a
dictionary of the corpus's common identifiers, to append the candidate to the
text around it:

    (size(around + candidate) - size(around)) / length,    around: without the candidate

A word, a path or an identifier is built from pieces that the dictionary or the
surrounding text already has, and costs little; a random string costs nearly
all its bytes or more.  Block headers and code tables make one measurement
noisy, so the median over the text before, after and on both sides counts.

The patterns are ASCII, so they are matched on UTF-8 bytes (lower-cased where
either case counts), and only hits are turned into code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import only
from sifter.llm.tokens import byte_table, groups, real_words

# The base patterns, on lower-cased bytes (assign) and on bytes (access, hex).
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")  # a longest run of 24 or more: what is left of [0-9a-f]+ without shorter ones
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "novel")

# Words that make what follows sensitive.
CONTEXT_WORDS = ("password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "api key", "access key", "access_key",
                 "private key", "private_key", "credential", "bearer", "authorization", "auth_", "signature")
CONTEXT = re.compile(rb"(?<![a-z0-9])(?:" + "|".join(sorted(CONTEXT_WORDS, key=len, reverse=True)).encode() + rb")")
RUN = re.compile(rb"(?<![A-Za-z0-9+/_.=~!@#$%^&*?-])[A-Za-z0-9+/_.=~!@#$%^&*?-]+")
MIN_CANDIDATE = 12
MARKS = b".,!?"  # at a candidate's end they belong to the sentence
REACH = 40  # bytes from the sensitive word to the candidate's first
AROUND = 768  # bytes of text on either side
NOVEL = 0.9  # on made-up strings in the given prose: 96 to 100 % of random ones reach it, 8 % of joined words
LEVEL = 3
DICTIONARY_WORDS = 4096
WORD_LETTERS = (3, 24)
SEPARATORS = bytes(b for b in range(128) if not (chr(b).isalnum() or b == 0x5F))


# --- identifier dictionary -----------------------------------------------------------

def identifier_counts(texts: DataFrame) -> DataFrame:
    """(word, n): how often each word of ASCII letters and underscores occurs in all of ``texts`` (one column)."""
    shape = f"^[A-Za-z_]{{{WORD_LETTERS[0]},{WORD_LETTERS[1]}}}$"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, group in groups(batch.column(0)):
                _, words = real_words(group, byte_table(SEPARATORS, lower=False))
                counts = pc.value_counts(words)
                values = counts.field(0)
                fit = pc.match_substring_regex(values, shape)
                yield pa.RecordBatch.from_arrays([values.filter(fit), counts.field(1).filter(fit)], ["word", "n"])

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common_identifiers(docs: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """The ``words`` most frequent identifiers of all texts, most frequent first; words with digits never count."""
    counts = identifier_counts(only(docs, "text"))
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(words).collect()]  # bounded by ``words``


class Novelty:
    """Marginal compressed bytes per byte, with the identifiers as dictionary."""

    def __init__(self, identifiers: Sequence[str]):
        raw = " ".join(reversed(identifiers)).encode()  # the most frequent are the nearest, and so the cheapest
        dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if raw else None
        if dictionary:
            dictionary.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False,
                                                 write_checksum=False, write_dict_id=False).compress

    def cost(self, candidate: bytes, around: bytes) -> float:
        return (len(self.compress(around + candidate)) - len(self.compress(around))) / len(candidate)

    def of(self, data: bytes, start: int, end: int) -> float:
        """The median cost of data[start:end] after the text before it, after it and on both sides."""
        candidate = data[start:end]
        before = data[max(0, start - AROUND):start].replace(candidate, b"")
        after = data[end:end + AROUND].replace(candidate, b"")
        return sorted(self.cost(candidate, around) for around in (before, after, before + after))[1]


# --- spans ---------------------------------------------------------------------------

def base_spans(data: bytes, lower: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes by the three patterns; ``lower``: the bytes with A-Z lower-cased."""
    spans = []
    if any(w in lower for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(lower) if len(m[2]) >= MIN_ASSIGN]
    if b"AKIA" in data:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data) if len(m[0]) >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(data)]
    return sorted(spans)


def candidates(data: bytes, lower: bytes) -> Iterator[tuple[int, int]]:
    """(start, end) of each long run of key characters that begins within REACH bytes after a sensitive word."""
    seen = -1  # the end of the last run looked at
    for word in CONTEXT.finditer(lower):
        at, reach = max(word.end(), seen), word.end() + REACH + 1
        while at < reach and (m := RUN.search(data, at, reach)):
            seen = at = RUN.match(data, m.start()).end()  # the whole run, also beyond the reach
            end = m.start() + len(data[m.start():at].rstrip(MARKS))
            if end - m.start() >= MIN_CANDIDATE:
                yield m.start(), end


def all_spans(data: bytes, novelty: Novelty) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, added) spans as (start, kind, end) in code points; added ones overlap no base span."""
    lower = data.lower()  # bytes: A-Z only
    base = base_spans(data, lower)
    added = []
    for start, end in candidates(data, lower):
        if not any(a < end and start < b for a, _, b in base) and novelty.of(data, start, end) >= NOVEL:
            added.append((start, 3, end))
    if not base and not added:
        return base, added
    places = sorted({p for a, _, b in base + added for p in (a, b)})
    points, at, n = {}, 0, 0
    for p in places:
        n += len(data[at:p].decode("utf-8", "surrogatepass"))
        points[p], at = n, p
    return tuple([(points[a], k, points[b]) for a, k, b in some] for some in (base, added))


def joined(spans: Sequence[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find_secrets(docs: DataFrame, identifiers: Sequence[str] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel, secrets of every whole text of ``docs`` (doc_id, text).

    ``spans``: kind:start:end of all spans by start, then kind, comma-joined, in
    code points; ``secrets`` holds them as (kind, start, end, text).  One row per
    input row.  NULL and empty texts have no spans; a sensitive word and its
    candidate may be anywhere in a text of any length.

    Two passes over the texts, no shuffle of them: one counts identifiers, whose
    commonest are broadcast (at most ``DICTIONARY_WORDS`` words of 24 letters),
    unless ``identifiers`` are given; one finds the spans.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(list(common_identifiers(docs) if identifiers is None else identifiers))
    texts = only(docs, "doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(shared.value)
        for batch in batches:
            for first, group in groups(batch.column(1)):
                rows = []
                for data in group.cast(pa.binary()).to_pylist():
                    base, added = all_spans(data, novelty)
                    kinds = [k for _, k, _ in base]
                    text = data.decode("utf-8", "surrogatepass") if base or added else ""
                    rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined(base).encode()).hexdigest(),
                                 joined(base + added), len(added),
                                 [{"kind": KINDS[k], "start": a, "end": b, "text": text[a:b]} for a, k, b in sorted(base + added)]))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(group)), *(pa.array(c, t) for c, t in zip(zip(*rows), types))],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel", "secrets"])

    return texts.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long, "
                                 "secrets array<struct<kind:string,start:long,end:long,text:string>>")


ship_by_value(__name__)
