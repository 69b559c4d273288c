"""Document collections: JSON lines on files, or a connector's own format."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ordering import col
from tidemark.operators.chunking import page_rows_by_kept_keys
from tidemark.sources.pipelines import ROW_STAGES, apply_pipeline, parse, top_fields


@dataclass(frozen=True)
class DocumentSource:
    """Collections below ``root`` as JSON, or in a database through a connector.

    With ``format='json'`` a collection is a folder.  Any other format is handed
    to Spark with ``options`` plus the names of the database and collection, and
    needs the connector's jar in the session.
    """

    spark: SparkSession
    root: str = ""
    format: str = "json"
    database: str = ""
    options: Mapping[str, str] = field(default_factory=dict)
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    kind: str = "documents"

    def with_database(self, database: str | None) -> DocumentSource:
        """Files know no database: there the name is not taken, so it is not reported either."""
        return replace(self, database=database) if database and not self._on_files() else self

    def _on_files(self) -> bool:
        return self.format == "json"

    def path(self, collection: str) -> str:
        return f"{self.root.rstrip('/')}/{collection}"

    def connector_options(self, collection: str, pipeline: str | None = None) -> dict[str, str]:
        opts = {**self.options, "database": self.database, "collection": collection}
        if pipeline is not None:
            opts["pipeline"] = pipeline
        return opts

    def read(self, collection: str, schema: str | None = None) -> DataFrame:
        """The whole collection; its structure is inferred by reading it."""
        return self._load(collection, None, None)

    def read_as(
        self,
        collection: str,
        columns: T.StructType | str,
        pipeline: str | None = None,
        stored: T.StructType | str | None = None,
    ) -> DataFrame:
        """The collection, or what ``pipeline`` makes of it, with a given structure.

        A connector gets the pipeline as it is.  On files it becomes part of the
        plan (see ``pipelines``), and its result takes the given structure:
        other fields go, missing ones are null.  ``stored`` is the structure of
        the documents themselves.  Without it, a pipeline that only filters,
        sorts and limits by fields among ``columns`` reads those, and any other
        one infers the structure by reading the collection once more.
        """
        if pipeline is None or not self._on_files():
            return self._load(collection, columns, pipeline)
        wanted = columns if isinstance(columns, T.StructType) else T.StructType.fromDDL(columns)
        stages = parse(pipeline)
        if stored is None and all(name in ROW_STAGES for name, _ in stages) and top_fields(stages) <= {*wanted.names}:
            stored = wanted
        made = apply_pipeline(self._load(collection, stored, None), pipeline)
        return made.select(
            *[(col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]
        )

    def _load(self, collection, columns, pipeline) -> DataFrame:
        reader = self.spark.read.format(self.format)
        if columns is not None:
            reader = reader.schema(columns)
        if self._on_files():
            return reader.options(**self.options).load(self.path(collection))
        return reader.options(**self.connector_options(collection, pipeline)).load()

    def row_count(self, collection: str, schema: str | None = None) -> int:
        whole_files = str(self.options.get("multiLine", "")).lower() == "true"
        if self._on_files() and not whole_files:
            lines = self.spark.read.text(self.path(collection)).where(F.trim("value") != "")
            return lines.agg(F.count(F.lit(1))).first()[0]
        return self.read(collection).agg(F.count(F.lit(1))).first()[0]

    def primary_key(self, collection: str, schema: str | None = None) -> tuple[str, ...]:
        return tuple(self.keys.get(collection, ()))

    def read_paged(
        self, collection: str, schema: str | None, keys: Sequence[str], chunk_size: int
    ) -> DataFrame:
        return page_rows_by_kept_keys(self.read(collection), keys, chunk_size)

    def overwrite(self, df: DataFrame, collection: str) -> None:
        self._save(df.write.mode("overwrite"), collection)

    def append(self, df: DataFrame, collection: str) -> None:
        self._save(df.write.mode("append"), collection)

    def _save(self, writer: DataFrameWriter, collection: str) -> None:
        writer = writer.format(self.format)
        if self._on_files():
            # Null fields are written out, so that a column that is null
            # throughout is still there when the collection is read back.
            options = {"ignoreNullFields": "false", **self.options}
            writer.options(**options).save(self.path(collection))
        else:
            writer.options(**self.connector_options(collection)).save()
