"""Fill-in-the-middle transformation with a piece table.

A document is a list of descriptors (buffer, start, length) over two immutable
buffers: the text, and the sentinels. Cutting splits descriptors, an arrangement
permutes them and puts sentinel descriptors before them, the inverse permutation
restores the document, and hashes stream the descriptors. No step copies a text;
only ``rendered`` makes one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketpulse.llm.common import table

#: The sentinel buffer, and where each sentinel lies in it
SENTINELS = "<P><S><M>"
PREFIX, SUFFIX, MIDDLE = ((0, 3), (3, 3), (6, 3))
TEXT, MARKS = 0, 1
#: Shares in per cent: documents that are transformed, and of those the ones with the suffix first
RATE, SUFFIX_FIRST = 90, 20
#: Parts (0 prefix, 1 middle, 2 suffix) in the order of each form, with the sentinel before each
FORMS = {"psm": ((0, PREFIX), (2, SUFFIX), (1, MIDDLE)), "spm": ((2, SUFFIX), (0, PREFIX), (1, MIDDLE))}
#: Code points that a hash takes in at once
SLICE = 1 << 16

PIECES = "array<struct<buffer:int,start:long,length:long>>"
Piece = tuple[int, int, int]


def unit_starts(text: str) -> np.ndarray:
    """Where tokens start: runs of ASCII letters, and every other code point by itself."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((points | 32) >= 97) & ((points | 32) <= 122) & (points < 128)
    starts = ~letter
    starts[:1] = True
    starts[1:] |= ~letter[:-1]
    return np.flatnonzero(starts)


def choices(doc_id: int | None) -> list[int]:
    """Four 32-bit numbers of a document, by its id; a missing id counts as empty."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def cut(pieces: list[Piece], points: list[int]) -> list[list[Piece]]:
    """The descriptors as parts that end at ``points`` (ascending offsets into the
    document) and a last one; a descriptor that holds a point is split."""
    parts, part, at, points = [], [], 0, list(points)
    for buffer, start, length in pieces:
        while points and points[0] < at + length:
            head = points.pop(0) - at
            parts.append(part + [(buffer, start, head)] if head else part)
            part, at, start, length = [], at + head, start + head, length - head
        part = part + [(buffer, start, length)] if length else part
        at += length
    return parts + [part] + [[] for _ in points]


def arranged(parts: list[list[Piece]], form: str) -> list[Piece]:
    """The parts in the order of ``form``, a sentinel before each."""
    return [piece for part, mark in FORMS[form] for piece in [(MARKS, *mark), *parts[part]]]


def restored(pieces: list[Piece], form: str) -> list[Piece]:
    """The document's own descriptors: those of an arrangement without its sentinels,
    by the inverse permutation."""
    if form not in FORMS:
        return pieces
    parts: list[list[Piece]] = []
    for piece in pieces:
        if piece[0] == MARKS:
            parts.append([])
        else:
            parts[-1].append(piece)
    order = [part for part, _ in FORMS[form]]
    return [piece for part in range(len(order)) for piece in parts[order.index(part)]]


def streamed(pieces: list[Piece], text: str) -> Iterator[bytes]:
    for buffer, start, length in pieces:
        source = text if buffer == TEXT else SENTINELS
        for at in range(start, start + length, SLICE):
            yield source[at:min(at + SLICE, start + length)].encode("utf-8", "surrogatepass")


def sha256(pieces: list[Piece], text: str) -> str:
    digest = hashlib.sha256()
    for data in streamed(pieces, text):
        digest.update(data)
    return digest.hexdigest()


def rendered(pieces: list[Piece], text: str) -> str:
    return "".join((text if b == TEXT else SENTINELS)[start:start + length] for b, start, length in pieces)


def transformed(doc_id: int | None, text: str, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, list[Piece], int | None, int | None]:
    """Tokens, form, descriptors and, unless plain, the code points of prefix and middle."""
    starts = unit_starts(text)
    n, whole = len(starts), [(TEXT, 0, len(text))] if text else []
    h1, h2, h3, h4 = choices(doc_id)
    if not text or h3 % 100 >= rate or any(SENTINELS[at:at + size] in text for at, size in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", whole, None, None
    first, second = (int(starts[i]) if i < n else len(text) for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    form = "spm" if h4 % 100 < suffix_first else "psm"
    return n, form, arranged(cut(whole, [first, second]), form), first, second - first


def fill_in_middle(docs: DataFrame, texts: bool = True, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per input row: ``doc_id, n`` (tokens), ``form`` (psm, spm, plain),
    ``pieces`` (descriptors of the output over the text, 0, and ``SENTINELS``, 1),
    ``prefix_chars, middle_chars`` (null if plain), ``output_sha256, restored_sha256`` and,
    with ``texts``, ``output``.

    A text that is null counts as empty; empty texts and texts that hold a sentinel stay
    plain. A missing id draws as an empty one. Texts of any length are taken whole.
    Rows that repeat an id come once each. An empty table gives an empty result;
    columns other than ``doc_id`` and ``text`` aren't looked at. A single pass without a
    shuffle: a row is worked on by itself."""
    names = ["doc_id", "n", "form", "pieces", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"] + ["output"] * texts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
        types = [pa.int64(), pa.int64(), pa.string(), piece, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = []
                for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(first, 256).columns)):
                    text = text or ""
                    n, form, pieces, prefix, middle = transformed(doc_id, text, rate, suffix_first)
                    spans = [dict(zip(("buffer", "start", "length"), p)) for p in pieces]
                    out = (rendered(pieces, text),) if texts else ()
                    rows.append((doc_id, n, form, spans, prefix, middle, sha256(pieces, text), sha256(restored(pieces, form), text), *out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = f"doc_id long, n long, form string, pieces {PIECES}, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, schema + (", output string" if texts else ""))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"), texts=False).drop("pieces")


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
r AS (
  SELECT *, len(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(t) + 1) AS p1, ('0x' || substr(h, 9, 8))::BIGINT % (len(t) + 1) AS p2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
f AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                 WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(t[1:least(p1, p2)], '') AS prefix, array_to_string(t[least(p1, p2) + 1:greatest(p1, p2)], '') AS middle,
         array_to_string(t[greatest(p1, p2) + 1:], '') AS suffix FROM r)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM f
"""
