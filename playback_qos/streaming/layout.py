"""Table and checkpoint locations under one base directory (no side effects)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """All layer tables and per-query checkpoints below ``base``.

    ``base`` must be shared storage on a cluster (HDFS, object store): the
    checkpoints are what lets a restarted query resume exactly once.
    """

    base: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    @property
    def source_raw(self) -> str:
        return self._p("source_raw")

    @property
    def bronze(self) -> str:
        return self._p("bronze")

    @property
    def validated(self) -> str:
        return self._p("bronze_validated")

    @property
    def dq_results(self) -> str:
        return self._p("dq_results")

    @property
    def silver(self) -> str:
        return self._p("silver")

    @property
    def gold_viewer(self) -> str:
        return self._p("gold", "viewer_qos")

    @property
    def gold_content(self) -> str:
        return self._p("gold", "content_qos")

    @property
    def gold_deltas(self) -> str:
        return self._p("gold", "deltas")

    @property
    def gold_base(self) -> str:
        return self._p("gold", "base")

    def bloom(self, table: str) -> str:
        return self._p("index", table)

    @property
    def telemetry(self) -> str:
        return self._p("telemetry")

    @property
    def telemetry_quarantine(self) -> str:
        return self._p("telemetry_quarantine")

    @property
    def buffering_intervals(self) -> str:
        return self._p("buffering_intervals")

    def checkpoint(self, query: str) -> str:
        return self._p("checkpoints", query)
