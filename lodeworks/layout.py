"""Where datasets live and how tables are written by default."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass


def parse_partition_cols(cols: str | Iterable[str] | None) -> list[str]:
    """Partition columns from a list or a comma string; empty or absent means none (K6)."""
    if not cols:
        return []
    names = cols.split(",") if isinstance(cols, str) else cols
    return [n.strip() for n in names if n.strip()]


@dataclass(frozen=True)
class LakeLayout:
    """Roots, prefixes and table defaults. Roots are any Hadoop file system URI."""

    bronze_root: str
    silver_root: str
    bronze_prefix: str = "raw/"
    silver_prefix: str = "processed/"
    quarantine_prefix: str = "invalid/"
    audit_prefix: str = "audit/"
    database: str = "silver"
    table_format: str = "parquet"
    compression: str = "snappy"
    partition_cols: tuple[str, ...] = ()

    @classmethod
    def under(cls, root: str, **overrides) -> LakeLayout:
        """Both layers below one root folder."""
        root = root.rstrip("/")
        return cls(bronze_root=f"{root}/bronze", silver_root=f"{root}/silver", **overrides)

    def bronze_path(self, dataset: str) -> str:
        return f"{self.bronze_root.rstrip('/')}/{self.bronze_prefix}{dataset}"

    @property
    def database_path(self) -> str:
        return f"{self.silver_root.rstrip('/')}/{self.silver_prefix}"

    def table_path(self, table: str) -> str:
        return f"{self.database_path}{table}"

    def metadata_path(self, table: str) -> str:
        return f"{self.table_path(table)}/_metadata"

    def quarantine_path(self, table: str) -> str:
        return f"{self.silver_root.rstrip('/')}/{self.quarantine_prefix}{table}"

    @property
    def audit_path(self) -> str:
        return f"{self.silver_root.rstrip('/')}/{self.audit_prefix}runs"
