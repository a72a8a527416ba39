"""Lake locations and run ids."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone


def new_run_id(now: datetime | None = None) -> str:
    """UTC run id such as ``20250131T093000Z``; without a given time a random suffix
    keeps runs of one second apart."""
    if now is not None:
        return now.strftime("%Y%m%dT%H%M%SZ")
    return f"{new_run_id(datetime.now(timezone.utc))}-{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class LakePaths:
    """Folders of one lake below any URI that Spark's file systems can reach."""

    root: str

    def _under(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw(self) -> str:
        return self._under("raw")

    @property
    def silver(self) -> str:
        return self._under("silver", "orders")

    @property
    def silver_batches(self) -> str:
        return self._under("silver", "orders_by_batch")

    @property
    def keys(self) -> str:
        return self._under("state", "keys")

    @property
    def key_log(self) -> str:
        return self._under("state", "batches")

    @property
    def retracted(self) -> str:
        return self._under("state", "retracted")

    @property
    def quarantine(self) -> str:
        return self._under("quarantine", "orders")

    @property
    def audit(self) -> str:
        return self._under("audit", "runs")

    @property
    def rejected_files(self) -> str:
        return self._under("quarantine", "files")

    def staging(self, name: str) -> str:
        """A run's own folder, below the lake so that all machines share it."""
        return self._under("_staging", f"{name}-{uuid.uuid4().hex}")

    def gold(self, mart: str) -> str:
        return self._under("gold", mart)

    def gold_batches(self, mart: str) -> str:
        return self._under("gold_by_batch", mart)

    def export(self, name: str) -> str:
        return self._under("export", name)

    def checkpoint(self, stream: str) -> str:
        return self._under("_checkpoints", stream)
