"""Fill-in-the-middle texts by block rotation in place.

A text is cut at two code points into prefix, middle and suffix. Its UTF-8 bytes
are copied into a bytearray with room for the three sentinels, which are written in
front of their segments in text order: <P>prefix <M>middle <S>suffix. Rotations
then bring the segments into the order of the form: the last two change places for
psm (<P>prefix<S>suffix<M>middle), and after that the first two for spm
(<S>suffix<P>prefix<M>middle). A rotation is three reversals, each of which swaps
pieces of at most PIECE bytes from both ends, so no second copy of a text is made.
``restore`` finds the sentinels, undoes the rotations and takes the sentinels out.

Cuts and forms come from a hash of the id alone, so a task that is run again
repeats them. Texts that hold a sentinel are left plain, which makes every sentinel
of an output the template's own.

Defined cases: a NULL text is empty, and empty texts stay plain. A NULL id counts
as the empty text in the hash. Repeated rows give repeated rows; rows that share an
id share the draw, not the cuts, which depend on the length as well. A segment may
be empty. Input columns other than id and text are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import query, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
FORMED, SPM = 90, 20        # per cent of the texts that are formed, of these in spm order
PIECE = 1 << 16


def draw(key: str) -> list[int]:
    """Four unsigned 32-bit numbers that belong to an id."""
    digest = hashlib.sha256(f"1:{key}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in range(0, 16, 4)]


def starts(text: np.ndarray) -> np.ndarray:
    """Which bytes of a UTF-8 text begin a code point."""
    return (text & 0xC0) != 0x80


def offsets(text: np.ndarray, cuts: tuple[int, int]) -> list[int]:
    """Byte offsets of ascending cuts that are given in code points, in one scan by pieces."""
    found, seen = [], 0
    wanted = list(cuts)
    for at in range(0, len(text), PIECE):
        first = starts(text[at:at + PIECE])
        here = int(first.sum())
        while wanted and wanted[0] < seen + here:
            found.append(at + int(np.flatnonzero(first)[wanted.pop(0) - seen]))
        seen += here
        if not wanted:
            break
    return found + [len(text)] * len(wanted)


def reverse(buffer: np.ndarray, i: int, j: int) -> None:
    while j - i > 1:
        n = min(PIECE, (j - i) // 2)
        left = buffer[i:i + n][::-1].copy()
        buffer[i:i + n] = buffer[j - n:j][::-1]
        buffer[j - n:j] = left
        i, j = i + n, j - n


def rotate(buffer: np.ndarray, i: int, j: int, k: int) -> None:
    """Let the bytes i to j and the bytes j to k change places."""
    reverse(buffer, i, j)
    reverse(buffer, j, k)
    reverse(buffer, i, k)


def arrange(text: bytes, cuts: tuple[int, int], form: str) -> bytearray:
    """``text``, cut at two byte offsets, in the order of ``form``."""
    a, b = cuts
    out = bytearray(len(text) + 3 * MARK)
    view = np.frombuffer(out, np.uint8)
    ends = (0, a, b, len(text))
    for k, mark in enumerate((PREFIX, MIDDLE, SUFFIX)):
        at = ends[k] + k * MARK
        out[at:at + MARK] = mark
        view[at + MARK:ends[k + 1] + (k + 1) * MARK] = np.frombuffer(text, np.uint8)[ends[k]:ends[k + 1]]
    middle, suffix = a + MARK, b + 2 * MARK
    rotate(view, middle, suffix, len(out))
    if form == "spm":
        rotate(view, 0, middle, middle + len(out) - suffix)
    return out


def rebuild(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    view = np.frombuffer(buffer, np.uint8)
    size = len(buffer)
    middle = buffer.find(MIDDLE)
    if form == "spm":
        prefix = buffer.find(PREFIX)
        rotate(view, 0, prefix, middle)
    suffix = buffer.find(SUFFIX)
    rotate(view, suffix, middle, size)
    middle = suffix         # the middle segment now begins where the suffix did
    suffix = buffer.find(SUFFIX)
    del view                # a bytearray that is viewed keeps its size
    for at in (suffix, middle, 0):
        del buffer[at:at + MARK]
    return bytes(buffer)


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", formed: int = FORMED, spm: int = SPM) -> DataFrame:
    """key, n (code points), form, prefix_chars, middle_chars (NULL if plain), output."""
    source = docs.select(
        F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for name, value in zip(batch.column(1).to_pylist(), batch.column(2)):
                body = value.as_py()
                array = np.frombuffer(body, np.uint8)
                n = int(starts(array).sum())
                h = draw(name)
                if not body or PREFIX in body or SUFFIX in body or MIDDLE in body or h[2] % 100 >= formed:
                    row = (n, "plain", None, None, body)
                else:
                    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                    form = "spm" if h[3] % 100 < spm else "psm"
                    row = (n, form, a, b - a, bytes(arrange(body, tuple(offsets(array, (a, b))), form)))
                for column, field in zip(columns, row):
                    column.append(field)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return found.select(F.col("id").alias(key), "n", "form", "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def restore(formed: DataFrame) -> DataFrame:
    """The rows of ``transform`` with ``restored``, the text rebuilt from form and output."""
    names = formed.columns

    def run(batches):
        at_form, at_output = names.index("form"), names.index("output")
        for batch in batches:
            texts = [rebuild(o.as_py(), f) for o, f in zip(batch.column(at_output).cast(pa.binary()), batch.column(at_form).to_pylist())]
            yield batch.append_column("restored", pa.array(texts, pa.binary()))

    found = formed.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in formed.dtypes) + ", restored binary")
    return found.withColumn("restored", F.col("restored").cast("string"))


_SQL = """
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
        FROM documents),
    u AS (
        SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS y,
               t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 AS plain,
               CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 AS spm
        FROM d),
    c AS (
        SELECT *, substring(t, 1, least(x, y)) AS p, substring(t, least(x, y) + 1, abs(x - y)) AS m, substring(t, greatest(x, y) + 1) AS s
        FROM u)
    SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
           CASE WHEN NOT plain THEN least(x, y) END AS prefix_chars, CASE WHEN NOT plain THEN abs(x - y) END AS middle_chars,
           sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM c"""


@query(_SQL)
def op12_fill_in_middle(spark, folder):
    done = restore(transform(table(spark, folder, "documents").select("doc_id", "text")))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))
