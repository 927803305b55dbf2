"""Token counts as rollups that signed changes maintain.

A ledger holds, batch by batch, signed rows for documents (an insert adds its
counts, a delete takes back what the ledger has for the document, a revision
does both) and their sums by source, language and tokenizer version. Totals are
the sums over all batches, so they never need the documents again. A batch is
written to folders of its own and then published as the ledger's next version,
which holds its name: it counts wholly or not at all, committing it again changes
nothing, and batches of several writers have an order. What a batch takes back is
what the ledger has in that order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import batches_of_bytes, text_bytes
from martflow.llm.tokens import ranks_encoder
from martflow.operators import versions
from martflow.operators.versions import Table, Version

BATCH_BYTES = 8 << 20
INSERT, DELETE, REVISE = "insert", "delete", "revise"
ROLLUP = ("source", "lang", "tokenizer")
MEASURES = ("n_docs", "n_bytes", "n_tokens")
ENTRIES = "doc_id long, source string, lang string, tokenizer string, n_docs long, n_bytes long, n_tokens long"
DELTAS = "source string, lang string, tokenizer string, n_docs long, n_bytes long, n_tokens long"


def _counter(vocabularies, pattern: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
            for tokenizer, vocabulary in vocabularies.value.items():
                tokens = ranks_encoder(vocabulary, pattern).counts(batch.column("text"))
                names = ["doc_id", "source", "lang", "n_docs", "n_bytes"]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n) for n in names], pa.array([tokenizer] * len(tokens)), pa.array(tokens)],
                    names=[*names, "tokenizer", "n_tokens"],
                ).select([f.split()[0] for f in ENTRIES.split(", ")])

    return count


class _Committed(Exception):
    """The batch has been committed by another writer."""


class TokenLedger:
    """Signed token counts below ``path``, a folder that all executors reach.

    ``tokenizers`` maps a version's name to its vocabulary in rank form.
    """

    def __init__(self, spark: SparkSession, path: str, tokenizers: dict[str, bytes], pattern: str):
        self.spark, self.path, self.pattern = spark, path.rstrip("/"), pattern
        self.vocabularies = spark.sparkContext.broadcast(tokenizers)

    def batches(self) -> list[str]:
        """Names of the committed batches, in their order."""
        return list(versions.last(self.spark, self.path).marks)

    def _read(self, version: Version, kind: str, schema: str) -> DataFrame:
        folders = version.tables.get(kind, Table()).folders
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}/{f}" for f in folders])

    def _write(self, entries: DataFrame) -> dict[str, str]:
        """Entries and their sums in new folders, which no version names yet."""
        part = versions.new_part()
        entries.write.parquet(f"{self.path}/entries/{part}")
        written = self.spark.read.schema(ENTRIES).parquet(f"{self.path}/entries/{part}")
        deltas = written.groupBy(*ROLLUP).agg(*[F.sum(m).alias(m) for m in MEASURES])
        deltas.write.parquet(f"{self.path}/deltas/{part}")
        return {"entries": part, "deltas": part}

    def count(self, docs: DataFrame) -> DataFrame:
        """Entries of documents: a row per document and tokenizer.

        A null text has no bytes and no tokens. Rows are counted as they come,
        null ids and repeated rows too; other columns are ignored.
        """
        rows = docs.select(
            F.col("doc_id").cast("long"),
            F.col("source").cast("string"),
            F.col("lang").cast("string"),
            F.lit(1).cast("long").alias("n_docs"),
            text_bytes(F.col("text")).alias("n_bytes"),
            "text",
        )
        return rows.mapInArrow(_counter(self.vocabularies, self.pattern), ENTRIES)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies ``changes`` (op, doc_id, source, lang, text) unless ``batch`` is committed; says whether it did.

        A delete or revision takes back all the ledger has for the id; for an id
        it does not have, a delete does nothing and a revision is an insert.
        Deletes and revisions of null ids are refused. Within a batch a document
        is deleted or revised before any of the batch is added.
        """
        known = F.lower("op").isin(INSERT, DELETE, REVISE) & (F.col("doc_id").isNotNull() | (F.lower("op") == INSERT))
        checked = changes.filter(
            F.when(F.coalesce(known, F.lit(False)), True).otherwise(
                F.raise_error(F.concat(F.lit("change that can't be applied: "), F.to_json(F.struct("op", "doc_id")))).cast(
                    "boolean"
                )
            )
        )
        present = versions.last(self.spark, self.path)
        if batch in present.marks:
            return False
        written = self._write(self.count(checked.filter(F.lower("op") != DELETE)))
        removes = checked.filter(F.lower("op") != INSERT).select(F.col("doc_id").cast("long")).distinct()
        takes_back = bool(present.tables) and not removes.isEmpty()
        while True:
            parts = [written]
            if takes_back:
                parts.append(self._write(self._taken_back(present, removes)))
            try:
                self._publish(batch, parts, present if takes_back else None)
                return True
            except versions.Conflict:
                # What was taken back is what the ledger had before the other batch: take back what it has now.
                present = versions.last(self.spark, self.path)
                takes_back = not removes.isEmpty()
            except _Committed:
                return False

    def _taken_back(self, version: Version, removes: DataFrame) -> DataFrame:
        return (
            self._read(version, "entries", ENTRIES)
            .join(removes, "doc_id", "left_semi")
            .groupBy("doc_id", *ROLLUP)
            .agg(*[(-F.sum(m)).alias(m) for m in MEASURES])
            .filter(" or ".join(f"{m} != 0" for m in MEASURES))
            .select(*[f.split()[0] for f in ENTRIES.split(", ")])
        )

    def _publish(self, batch: str, parts: list[dict[str, str]], seen: Version | None) -> None:
        def change(latest: Version) -> dict[str, Table]:
            if batch in latest.marks:
                raise _Committed
            if seen is not None:
                versions.unchanged(seen, "entries")(latest)
            return {
                kind: Table({**latest.tables.get(kind, Table()).folders, **{part[kind]: None for part in parts}})
                for kind in ("entries", "deltas")
            }

        versions.publish(self.spark, self.path, change, mark=batch)

    def compact(self) -> None:
        """Fold all batches into one folder of entries and one of deltas; totals and batches stay as they are.

        A batch that is committed meanwhile fails it.
        """
        present = versions.last(self.spark, self.path)
        entries = self._read(present, "entries", ENTRIES).groupBy("doc_id", *ROLLUP).agg(*[F.sum(m).alias(m) for m in MEASURES])
        held = entries.filter(" or ".join(f"{m} != 0" for m in MEASURES))
        written = self._write(held.select(*[f.split()[0] for f in ENTRIES.split(", ")]))

        def change(latest: Version) -> dict[str, Table]:
            versions.unchanged(present, "entries")(latest)
            return {kind: Table({part: None}) for kind, part in written.items()}

        versions.publish(self.spark, self.path, change)

    def totals(self) -> DataFrame:
        """n_docs, n_bytes and n_tokens by source, lang and tokenizer. Groups without documents are left out."""
        present = versions.last(self.spark, self.path)
        sums = self._read(present, "deltas", DELTAS).groupBy(*ROLLUP).agg(*[F.sum(m).alias(m) for m in MEASURES])
        return sums.filter("n_docs != 0")

    def documents(self) -> DataFrame:
        """What the ledger has for each document and tokenizer."""
        present = versions.last(self.spark, self.path)
        sums = self._read(present, "entries", ENTRIES).groupBy("doc_id", *ROLLUP).agg(*[F.sum(m).alias(m) for m in MEASURES])
        return sums.filter("n_docs != 0")


def token_totals(docs: DataFrame, path: str, tokenizers: dict[str, bytes], pattern: str) -> DataFrame:
    """Totals of ``docs`` (doc_id, source, lang, text) in a new ledger at ``path``, by inserts, deletes and revisions.

    All documents are announced under placeholders, with their source as text,
    and once more under other ids, which are withdrawn; then every document is
    revised to what it is, and the last batch comes twice. Documents without an
    id are inserted. Null texts count no tokens; null sources and languages are
    groups; repeated rows and null ids count each time; an empty table has no
    groups; further columns are ignored.
    """
    ledger = TokenLedger(docs.sparkSession, path, tokenizers, pattern)
    named = docs.filter("doc_id is not null")
    other = (-F.lit(1) - F.col("doc_id")).alias("doc_id")
    unknown = F.lit(None).cast("string")
    announced = [F.lit(INSERT).alias("op"), unknown.alias("source"), unknown.alias("lang"), F.col("source").cast("string").alias("text")]
    whole = ["doc_id", "source", "lang", "text"]
    ledger.commit("announce", named.select("doc_id", *announced).unionByName(named.select(other, *announced)))
    ledger.commit("withdraw", named.select(F.lit(DELETE).alias("op"), other, "source", "lang", "text"))
    op = F.when(F.col("doc_id").isNull(), INSERT).otherwise(REVISE)
    for _ in range(2):
        ledger.commit("load", docs.select(op.alias("op"), *whole))
    return ledger.totals()
