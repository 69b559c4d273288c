"""Readers' leases on published versions, and the removal of versions that nobody needs.

A reader that must finish on the version it began with takes a lease on it; a
clean-up leaves that version until the lease is given back or runs out.  The
reader enters its lease and then looks for the mark of removal, the clean-up
enters the mark and then looks for leases: so at least one of them sees the
other, and no version is removed under a lease that was granted.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from typing import TYPE_CHECKING

from tidemark.workspace import create_text, file_names, path_exists, read_text, remove

if TYPE_CHECKING:
    from tidemark.sinks.published import PublishedTable

LEASE_SECONDS = 24 * 3600
# A version that was staged but not published may still be on its way for so long.
SETTLE = timedelta(days=7)


class VersionGone(LookupError):
    """The version is being removed or has been."""


def _leases(table: PublishedTable, version: str) -> str:
    return f"{table.root}/leases/{version}"


def _mark(table: PublishedTable, version: str) -> str:
    return f"{table.root}/retired/{version}"


def take_lease(table: PublishedTable, version: str, seconds: float = LEASE_SECONDS) -> str:
    """Keep ``version`` for ``seconds`` by the clocks of the two drivers; the lease, to be given back."""
    lease = f"{_leases(table, version)}/{uuid.uuid4().hex}"
    create_text(table.spark, lease, str(time.time() + seconds))
    if path_exists(table.spark, _mark(table, version)):
        remove(table.spark, lease)
        raise VersionGone(f"{version} is being removed")
    return lease


def give_back(table: PublishedTable, lease: str) -> None:
    remove(table.spark, lease)


@contextmanager
def held(table: PublishedTable, version: str, seconds: float = LEASE_SECONDS) -> Iterator[None]:
    """No clean-up removes ``version`` meanwhile."""
    lease = take_lease(table, version, seconds)
    try:
        yield
    finally:
        give_back(table, lease)


def is_leased(table: PublishedTable, version: str) -> bool:
    """Whether a lease on the version is running; one that is still being written counts."""
    folder = _leases(table, version)
    for name in file_names(table.spark, folder):
        if not name.startswith("."):
            until = read_text(table.spark, f"{folder}/{name}")
            if until is not None and (until == "" or float(until) > time.time()):
                return True
    return False


def _begun(version: str) -> datetime:
    return datetime.strptime(version.split("-")[0], "%Y%m%dT%H%M%S%f").replace(tzinfo=timezone.utc)


def clean(table: PublishedTable, keep: int = 1, settle: timedelta = SETTLE) -> list[str]:
    """Remove versions that are not live; their names.

    The last ``keep`` versions that were live before stay, so that they can be
    made live again, as do versions under a lease and those that were staged
    less than ``settle`` ago and never published.  A clean-up that broke off is
    finished by the next one.
    """
    spark, removed = table.spark, []
    published = list(dict.fromkeys(reversed(table.published_versions())))
    spared = set(published[: 1 + keep])
    now = datetime.now(timezone.utc)
    for version in file_names(spark, f"{table.root}/versions"):
        young = version not in published and now - _begun(version) < settle
        if version in spared or young or is_leased(table, version):
            continue
        create_text(spark, _mark(table, version), "")
        if is_leased(table, version) or table.live_version() == version:
            remove(spark, _mark(table, version))
            continue
        table.forget(version)
        remove(spark, _leases(table, version))
        removed.append(version)
    return removed
