"""Fill-in-the-middle forms of texts, cut between lines.

A text's lines are the units of an indexable skip list, whose express lanes
carry unit widths and code-point widths; both cuts are ranks drawn from a hash
of the document's id, and a descent by accumulated widths gives the code points
before each. Rows never meet, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import batches_of_bytes, packed
from martflow.llm.skip_list import SkipList

SEED = 7
#: Out of 100: texts that are transformed at all, and of these the ones with the suffix first.
RATE, SUFFIX_FIRST = 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BATCH_BYTES = 8 << 20

FORMS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, _kept struct<{kept}>"


def line_widths(text: str) -> np.ndarray:
    """Code points of each line, its line feed included."""
    widths = np.fromiter(map(len, text.split("\n")), dtype=np.int64)
    widths[:-1] += 1
    return widths if widths[-1] else widths[:-1]


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the hash of a document's id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def transform(text: str, doc_id: int | None, seed: int, rate: int, suffix_first: int) -> tuple:
    """(units, form, code points of the prefix, of the middle, output)."""
    widths = line_widths(text)
    first, second, kind, order = draws(seed, doc_id)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or kind % 100 >= rate:
        return len(widths), "plain", None, None, text
    lines = SkipList(widths)
    a, b = sorted(lines.seek(cut % (len(widths) + 1)) for cut in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < suffix_first:
        return len(widths), "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return len(widths), "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its text in fill-in-the-middle form.

    Returns doc_id, n (lines), form, prefix_chars and middle_chars (code points),
    output, and the other columns of ``docs`` in one struct ``_kept``, where no
    name can clash. The form is ``plain``, with the text as output and null
    counts, if the text is null (taken as empty) or empty, holds one of the
    marks, or is left alone by ``rate``; else ``psm`` or ``spm``. A null id is
    hashed as no digits. A repeated id cuts equal texts at the same places;
    repeated rows are transformed one by one. Text length is bounded by a task's
    memory only. An empty table gives an empty result.
    """
    rows = packed(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text")
    kept = rows.schema["_kept"].dataType

    def each(batches):
        for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
            found = [
                transform(text or "", doc_id, seed, rate, suffix_first)
                for text, doc_id in zip(batch.column("text").to_pylist(), batch.column("doc_id").to_pylist(), strict=True)
            ]
            n, form, prefix_chars, middle_chars, output = zip(*found, strict=True) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix_chars, pa.int64()),
                    pa.array(middle_chars, pa.int64()),
                    pa.array(output, pa.string()),
                    batch.column("_kept"),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "_kept"],
            )

    schema = FORMS.format(kept=", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in kept.fields))
    return rows.mapInArrow(each, schema)


def restored() -> F.Column:
    """The text from ``output`` and ``form``.

    The text itself holds no mark, and a mark has no part that is both its start
    and its end, so the first place of each mark is the one it was put at.
    """
    return F.expr(
        f"""
        CASE form
          WHEN 'psm' THEN concat(
            substring(output, 4, locate('{SUFFIX}', output) - 4),
            substring(output, locate('{MIDDLE}', output) + 3),
            substring(output, locate('{SUFFIX}', output) + 3, locate('{MIDDLE}', output) - locate('{SUFFIX}', output) - 3))
          WHEN 'spm' THEN concat(
            substring(output, locate('{PREFIX}', output) + 3, locate('{MIDDLE}', output) - locate('{PREFIX}', output) - 3),
            substring(output, locate('{MIDDLE}', output) + 3),
            substring(output, 4, locate('{PREFIX}', output) - 4))
          ELSE output
        END"""
    )


def with_digests(forms: DataFrame) -> DataFrame:
    """The result of ``fill_in_middle`` with digests of output and of the rebuilt text instead of the output."""
    return forms.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"),
    )
