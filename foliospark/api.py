"""Python facade over the tables of a workspace folder: ingest, lookup, search, extract, evaluate, related, health."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.models import Embedder, HashingEmbedder
from foliospark.operators import chunking, evaluation, extraction, graph, retrieval, routing
from foliospark.schemas import EDGES, LISTS, NODES, SCALARS


def _check(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


LEDGER = "table string, doc_id string, batch string, seq long"


class Workspace:
    """Parquet tables under a folder. A write appends a batch with an id of its own to a table, and is then recorded in
    the ledger for each document; of a document, the rows of its last recorded batch in a table count. A write that fails
    isn't recorded, so its rows never count."""

    def __init__(self, spark: SparkSession, folder: str, embedder: Embedder | None = None):
        self.spark, self.folder, self.embedder = spark, folder.rstrip("/"), embedder or HashingEmbedder()

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _ledger(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(f"{self.folder}/ledger") if self._exists("ledger") else self.spark.createDataFrame([], LEDGER)

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """The table's current rows; an empty table with the schema if nothing was written. Of vectors, the last written
        one of each chunk id."""
        if not self._exists(name):
            return self.spark.createDataFrame([], schema or "doc_id string, batch string, seq long")
        last = self._ledger().where(F.col("table") == name).groupBy("doc_id").agg(F.max(F.struct("seq", "batch")).alias("x"))
        rows = self.spark.read.parquet(f"{self.folder}/{name}").join(last.select("doc_id", "x.batch", "x.seq"), ["doc_id", "batch"])
        if name == "vectors":
            rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("chunk_id").orderBy(F.desc("seq"), F.desc("doc_id")))).where("_n = 1").drop("_n")
        return rows

    def _append(self, rows: DataFrame, name: str, batch: str) -> None:
        rows.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{self.folder}/{name}")

    def _record(self, docs: DataFrame, tables: Sequence[str], batch: str) -> None:
        """Makes the batch the last one of the documents (doc_id) in the tables."""
        rows = docs.select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("table"), F.col("doc_id").cast("string").alias("doc_id"), F.lit(batch).alias("batch"), F.lit(time.time_ns()).alias("seq"))
        rows.write.mode("append").parquet(f"{self.folder}/ledger")

    def new_documents(self, docs: DataFrame) -> DataFrame:
        """The rows of documents that no ingest has recorded."""
        return docs.join(self._ledger().where(F.col("table") == "chunks").select("doc_id"), "doc_id", "left_anti")

    def submit(self, docs: DataFrame, *, force: bool = False) -> DataFrame:
        """(doc_id, status) before an ingest of the documents (doc_id): queued, or already_exists without force."""
        asked = docs.select("doc_id").distinct()
        if force:
            return asked.withColumn("status", F.lit("queued"))
        new = self.new_documents(asked).withColumn("status", F.lit("queued"))
        return asked.join(new, "doc_id", "left").select("doc_id", F.coalesce("status", F.lit("already_exists")).alias("status"))

    def ingest(self, blocks: DataFrame, *, force: bool = False) -> DataFrame:
        """(doc_id, status) of documents given as blocks: completed, or already_exists without force.

        Documents are routed, chunked and embedded; the ingest is recorded last, so a failed one leaves no rows that count.
        """
        new = blocks if force else self.new_documents(blocks)
        batch = uuid.uuid4().hex
        chunks = chunking.chunk(new)
        self._append(routing.route_documents(new), "routes", batch)
        self._append(chunks, "chunks", batch)
        self._append(retrieval.index_chunks(chunks, self.embedder).withColumn("doc_id", F.col("source_path")), "vectors", batch)
        self._record(new.select("doc_id").distinct(), ["routes", "chunks", "vectors"], batch)
        done = self._ledger().where((F.col("batch") == batch) & (F.col("table") == "chunks")).select("doc_id", F.lit("completed").alias("status"))
        return blocks.select("doc_id").distinct().join(done, "doc_id", "left").select("doc_id", F.coalesce("status", F.lit("already_exists")).alias("status"))

    def add_extractions(self, partials: DataFrame, *, strategy: str = "union") -> DataFrame:
        """Merges per-page results, keeps the valid ones, and returns the invalid ones with their reason."""
        good, bad = extraction.validate(extraction.merge_extractions(partials, strategy=strategy))
        batch = uuid.uuid4().hex
        self._append(good, "extractions", batch)
        self._record(good.select("doc_id"), ["extractions"], batch)
        return bad

    def graph(self) -> tuple[DataFrame, DataFrame]:
        """Nodes and edges of all extractions."""
        if not self._exists("extractions"):
            return self.spark.createDataFrame([], NODES), self.spark.createDataFrame([], EDGES)
        nodes, edges = graph.paper_writes(self.read("extractions").withColumn("seq", F.struct("seq", "doc_id")))
        made = graph.upsert_nodes(nodes)
        return made, graph.upsert_edges(edges, made)

    def paper(self, arxiv_id: str):
        """The stored extraction; KeyError if there is none."""
        found = self.read("extractions").where(F.col("arxiv_id") == arxiv_id).head() if self._exists("extractions") else None
        if found is None:
            raise KeyError(arxiv_id)
        return found

    def search(self, query: str, *, top_k: int = 10, filters: Mapping[str, object] | None = None, min_score: float = 0.0) -> DataFrame:
        """The query is 3 to 1000 characters long, top_k 1 to 50."""
        _check(3 <= len(query) <= 1000, "query: 3 to 1000 characters")
        _check(1 <= top_k <= 50, "top_k: 1 to 50")
        return retrieval.retrieve(self.read("vectors"), query, self.embedder, top_k=top_k, rerank_top_k=top_k, filters=filters, min_score=min_score)

    def extract(self, arxiv_id: str, fields: Sequence[str] | None = None) -> DataFrame:
        known = [*SCALARS, *LISTS]
        chosen = known if not fields else list(fields)
        _check(set(chosen) <= set(known), f"fields: some of {known}")
        return self.read("extractions").where(F.col("arxiv_id") == arxiv_id).select(*chosen)

    def evaluate(self, sources: DataFrame) -> DataFrame:
        """(doc_id, consistency, hallucination_rate) of the extractions with sources (doc_id, source_text)."""
        found = self.read("extractions")
        consistent = evaluation.consistency_report(found).select("doc_id", F.col("score").alias("consistency"))
        flags = evaluation.hallucination_report(found, evaluation.hallucination_checks(found, sources))
        return consistent.join(flags, "doc_id")

    def related(self, arxiv_id: str, *, max_hops: int = 2, rel_types: Sequence[str] | None = None) -> DataFrame:
        _check(1 <= max_hops <= 3, "max_hops: 1 to 3")
        nodes, edges = self.graph()
        return graph.find_related_papers(nodes, edges, arxiv_id, max_hops=max_hops, rel_types=rel_types, paths=True)

    def health(self) -> dict[str, str]:
        return {"status": "ok"}
