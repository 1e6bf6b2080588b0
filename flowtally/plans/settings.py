"""What a run needs to know besides its steps. Plain values and DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame

from flowtally.sources.cachestore import CacheStore


@dataclass(frozen=True)
class Settings:
    source: str = "logs"
    resolver: str = "default"
    min_count: int = 1
    stream_id: str | None = None
    allowlist: Sequence[str] = ()
    cidrs: Sequence[str] = ()
    match_mode: str = "or"
    # Response tables by the names the resolvers know, and switches for their tiers.
    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    resolver_options: Mapping[str, Any] = field(default_factory=dict)
    cache: CacheStore | None = None
    now: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))
