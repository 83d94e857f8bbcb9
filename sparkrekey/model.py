"""Specs of tables that issue keys and columns that hold them, their states, and the results' schemas."""

from __future__ import annotations

from dataclasses import dataclass, field

ARCHETYPES = ("SCD1", "SCD2", "HUB_SCD2")
CLASSIFICATIONS = ("LEGACY_KEYED", "RELOADED", "MIXED")
MAP_STATUSES = ("MATCHED", "ORPHAN_OLD", "ORPHAN_NEW", "AMBIGUOUS")
REPAIR_STATUSES = ("DISCOVERED", "SELECTED", "VERIFIED", "FIXED", "SKIPPED", "EXCLUDED", "NOT_APPLICABLE")
ACTIVE = ("SELECTED", "VERIFIED")
CLONE_STATUSES = ("ACTIVE", "PROMOTED", "SUPERSEDED")
#: What a key-map says of how versions meet: the name of its property, and its value by archetype or path.
MATCH_PROPERTY = "ri_repair.version_match"
MATCHES = {"SCD1": "none-scd1", "A": "A-exact", "B": "B-event-date"}
#: Defaults of thresholds.
PATH_A_SHARE, SUGGEST_SHARE, TOLERANCE, ORPHAN_WARNING = 0.99, 0.95, 0.01, 0.01


@dataclass(frozen=True)
class ProviderSpec:
    """A table that issues surrogate keys."""

    provider_table: str
    archetype: str
    sk_col: str
    nk_cols: tuple[str, ...]
    topo_level: int = 0
    effective_start_col: str | None = None
    effective_end_col: str | None = None
    record_status_col: str | None = None
    nk_type_overrides: dict[str, str] = field(default_factory=dict)
    use_status_tiebreaker: bool = False
    version_match_path: str | None = None
    enabled: bool = True
    notes: str | None = None

    def __post_init__(self):
        if self.archetype not in ARCHETYPES:
            raise ValueError(f"archetype must be one of {ARCHETYPES}: {self.archetype}")
        if self.versioned and not self.effective_start_col:
            raise ValueError(f"{self.provider_table}: a versioned table needs its start column")
        if not self.nk_cols:
            raise ValueError(f"{self.provider_table}: a natural key needs a column")

    @property
    def versioned(self) -> bool:
        return self.archetype != "SCD1"


@dataclass(frozen=True)
class ConsumerRole:
    """A column that holds a provider's keys."""

    consumer_table: str
    fk_col: str
    provider_table: str
    event_date_col: str | None = None
    measure_cols: tuple[str, ...] = ()
    classification: str | None = None
    repair_status: str = "DISCOVERED"
    excluded: bool = False
    exclusion_reason: str | None = None
    notes: str | None = None

    @property
    def key(self) -> str:
        return f"{self.consumer_table}::{self.fk_col}"

    @property
    def hash_cols(self) -> tuple[str, str]:
        return f"{self.fk_col}_nk_hash", f"{self.fk_col}_ver_hash"


CLONES = "run_id STRING, logical_table STRING, table_kind STRING, wip_table_name STRING, clone_status STRING, row_key_cols ARRAY<STRING>, cloned_at TIMESTAMP, promoted_at TIMESTAMP, promote_mode STRING, notes STRING"
AUDIT = {
    "gate_results": "run_id STRING, table_name STRING, gate STRING, violations BIGINT, passed BOOLEAN, run_at TIMESTAMP",
    "version_diagnostics": "run_id STRING, provider_table STRING, status STRING, version_rows BIGINT, matched_pct DOUBLE, suggested_path STRING, run_at TIMESTAMP",
    "keymap_audit": "run_id STRING, provider_table STRING, map_status STRING, cnt BIGINT, run_at TIMESTAMP",
    "classification_evidence": "run_id STRING, consumer_table STRING, fk_col STRING, provider_table STRING, map_status STRING, cnt BIGINT, suggested STRING, run_at TIMESTAMP",
    "validation_results": "run_id STRING, consumer_table STRING, fk_col STRING, provider_table STRING, check_name STRING, violations BIGINT, verdict STRING, detail STRING, run_at TIMESTAMP",
    "sweep_results": "run_id STRING, consumer_table STRING, fk_col STRING, provider_table STRING, action STRING, rows_updated BIGINT, post_check_violations BIGINT, run_at TIMESTAMP",
    "discovery_edge_cases": "run_id STRING, provider_table STRING, sk_col STRING, candidate_table STRING, candidate_column STRING, reason STRING, status STRING, found_at TIMESTAMP",
}
