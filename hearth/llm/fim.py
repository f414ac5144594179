"""Fill-in-middle: a text is cut into prefix, middle and suffix, and the middle is moved to the end.

One full match of ``(unit)*`` cuts a text: a regular expression library that keeps every
repetition of a group returns the ends of all units at once, so their number and both places
to cut are read off that list. A unit is a run of ASCII letters or any other character.
The quantifiers are possessive, so that nothing is kept for backtracking in a long text.

Where a text is cut, and whether it is, follows from four numbers in the SHA-256 of a seed and
the document's id; a document with the same id and text is cut alike wherever it lies. Rows are
independent of each other: nothing is grouped or shuffled, and batches are bounded by bytes.

A null text counts as empty. An empty text, or one that contains a marker, stays plain. A null
id counts as an empty one in the hash and stays null. Repeated rows are all kept. Only the two
named columns are read, so other columns cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from hearth.llm.common import fields, map_batches, slices

UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: In per cent: texts that stay plain, and of the others those with the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
SEED = 1


def transform(text: str, doc_id: int | None, seed: int = SEED) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, characters of the prefix, of the middle, output) of one text."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i : i + 4]) for i in (0, 4, 8, 12))
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= 100 - PLAIN:
        return n, "plain", None, None, text
    a, b = (ends[u - 1] if u else 0 for u in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every document."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rest = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]

    def make():
        def step(batch: pa.RecordBatch):
            for b in slices(batch, 1):
                cut = [transform(t, i, seed) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
                cols = [pa.array(list(c), kind) for c, (_, kind) in zip(zip(*cut, strict=True), rest, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["id", *(n for n, _ in rest)])

        return step

    return map_batches(source, make, fields(StructField("id", source.schema["id"].dataType), "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text, rebuilt from output and form.

    No marker can begin inside another or in the text, so an output holds three of them.
    """
    parts = F.split(F.col(output), "<[PSM]>", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
