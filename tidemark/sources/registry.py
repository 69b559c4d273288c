"""Opening a source from configuration.

Configuration is ``client -> source name -> settings``.  Every source states its
``kind``; the kind is never guessed from the source's name.  A secret is given
as ``{"env": NAME}`` or ``{"conf": KEY}`` and looked up when the source opens.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

from tidemark.sources.documents import DocumentSource
from tidemark.sources.files import FileSource
from tidemark.sources.jdbc import DEFAULT_CONNECTIONS, JdbcSource

Settings = Mapping[str, object]

_COUNTS = ("rows_per_range", "max_connections", "write_connections", "write_batch")


def secret(spark: SparkSession, setting: object) -> str | None:
    if setting is None:
        return None
    if isinstance(setting, Mapping) and "env" in setting:
        return os.environ[setting["env"]]
    if isinstance(setting, Mapping) and "conf" in setting:
        return spark.conf.get(setting["conf"])
    raise ValueError('a secret is given as {"env": NAME} or {"conf": KEY}')


def _jdbc(kind: str) -> Callable[[SparkSession, Settings], JdbcSource]:
    def build(spark: SparkSession, settings: Settings) -> JdbcSource:
        return JdbcSource(
            spark,
            kind,
            settings["url"],
            settings["driver"],
            settings.get("username"),
            secret(spark, settings.get("password")),
            settings.get("database", ""),
            int(settings.get("connections", DEFAULT_CONNECTIONS)),
            settings.get("options", {}),
            **{k: int(settings[k]) for k in _COUNTS if k in settings},
        )

    return build


def _files(spark: SparkSession, settings: Settings) -> FileSource:
    given = {k: settings[k] for k in ("format", "layout", "keys", "options") if k in settings}
    return FileSource(spark, settings["root"], **given)


def _documents(spark: SparkSession, settings: Settings) -> DocumentSource:
    names = ("root", "format", "database", "options", "keys")
    given = {k: settings[k] for k in names if k in settings}
    given["options"] = {
        k: secret(spark, v) if isinstance(v, Mapping) else v
        for k, v in settings.get("options", {}).items()
    }
    return DocumentSource(spark, **given)


KINDS: dict[str, Callable] = {
    "sqlserver": _jdbc("sqlserver"),
    "mssql": _jdbc("sqlserver"),
    "postgres": _jdbc("postgres"),
    "postgresql": _jdbc("postgres"),
    "files": _files,
    "documents": _documents,
}


def open_source(spark: SparkSession, config: Mapping, client: str, name: str):
    """The source ``name`` of ``client``; its kind may be written in any case."""
    settings = config[client][name]
    kind = str(settings.get("kind", "")).lower()
    if kind not in KINDS:
        raise ValueError(f"{name}: unknown kind {kind!r}; known kinds: {', '.join(sorted(KINDS))}")
    return KINDS[kind](spark, settings)
