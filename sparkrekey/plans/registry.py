"""Settings, profiles, configuration documents and the state of each role."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrekey.model import ACTIVE, CLASSIFICATIONS, REPAIR_STATUSES, ConsumerRole, ProviderSpec

#: Setting names and defaults.
DEFAULTS = {
    "setup_profile": "scd1_dim_fact", "target_catalog": "target_catalog", "target_schema": "silver", "source_catalog": "legacy_src", "source_schema": "dbo",
    "config_schema": "ri_repair", "staging_schema": "staging", "keymap_schema": "keymap", "wip_schema": "ri_wip", "provider_filter": "*", "consumer_filter": "*", "dry_run": "false",
    "repair_target_mode": "wip_clone", "accept_in_place_risk": "false", "wip_run_id": "", "providers_json": "[]", "manual_consumers_json": "[]", "exclude_consumers_json": "[]",
    "repair_mode": "opt_in", "repair_selection_json": "[]", "refresh_snapshots": "false", "auto_set_path": "true", "path_a_threshold": "0.99", "build_keymaps": "true", "recompute_hashes": "false",
    "mode": "classify", "suggest_threshold": "0.95", "classifications_json": "[]", "consumer_overrides_json": "[]", "measure_tolerance": "0.01", "require_validation": "true", "orphan_sk": "-1",
    "apply_orphan_sk": "false", "promote_mode": "merge_columns", "wip_row_keys_json": "[]", "promote_view_prefix": "v_", "validation_target": "auto",
}
CHOICES = {"repair_target_mode": ("wip_clone", "in_place"), "repair_mode": ("opt_in", "opt_out"), "mode": ("classify", "populate"), "promote_mode": ("merge_columns", "swap_table", "repoint_view"), "validation_target": ("auto", "wip", "prod")}
#: Stages in order, and what each profile leaves out.
STAGES = ("discover", "triage", "snapshot", "clone", "provider_hash", "classify", "populate", "validate", "sweep", "promote")
PROFILES = {"full": (), "scd1_dim_fact": (), "scd2_dim_fact": (), "hub_scd2_wave": (), "fact_consumer": ("snapshot", "provider_hash")}
#: What a profile sets where nothing is given.
PROFILE_DEFAULTS = {
    "scd1_dim_fact": {"auto_set_path": "false", "mode": "classify"}, "scd2_dim_fact": {"mode": "classify"}, "hub_scd2_wave": {"mode": "classify"},
    "fact_consumer": {"provider_filter": "*", "refresh_snapshots": "false", "build_keymaps": "false", "mode": "classify"},
}


def settings(given: dict[str, str] | None = None) -> dict[str, str]:
    """The defaults, the profile's, and what is given (an empty text counts as not given); unknown names and values are errors."""
    given = {k: v for k, v in (given or {}).items() if v is not None and v.strip()}
    out = {**DEFAULTS, **PROFILE_DEFAULTS.get(given.get("setup_profile", DEFAULTS["setup_profile"]), {}), **given}
    if unknown := set(out) - set(DEFAULTS):
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    if out["setup_profile"] not in PROFILES:
        raise ValueError(f"unknown profile: {out['setup_profile']}")
    for name, allowed in CHOICES.items():
        if out[name] not in allowed:
            raise ValueError(f"{name} must be one of {allowed}: {out[name]}")
    if out["repair_target_mode"] == "in_place" and out["accept_in_place_risk"] != "true":
        raise ValueError("writing in place needs accept_in_place_risk")
    return out


def stages(profile: str) -> list[str]:
    return [s for s in STAGES if s not in PROFILES[profile]]


def activate(store, given: dict[str, str]) -> None:
    """Makes the settings the store's only active ones, in one move of the table's pointer; earlier rows stay, inactive."""
    row = store.spark.createDataFrame([(json.dumps(settings(given)), True)], "settings string, active boolean")
    if store.exists("config", "package_settings"):
        row = store.read("config", "package_settings").withColumn("active", F.lit(False)).unionByName(row)
    store.write("config", "package_settings", row)


def active(store) -> dict[str, str]:
    """The store's active settings; anything but exactly one active row is an error."""
    rows = store.read("config", "package_settings").filter("active").limit(2).collect() if store.exists("config", "package_settings") else []
    if len(rows) != 1:
        raise ValueError(f"{len(rows)} active settings rows where there must be one" if len(rows) < 2 else "several active settings rows where there must be one")
    return settings(json.loads(rows[0]["settings"]))


def review(roles: DataFrame, providers: DataFrame) -> DataFrame:
    """The registered roles with their provider's archetype, in the order of display."""
    kinds = providers.select(F.lower("provider_table").alias("_p"), "archetype").distinct()
    out = roles.join(kinds, F.lower("provider_table") == F.col("_p"), "left").drop("_p")
    return out.orderBy("repair_status", "provider_table", "consumer_table", "fk_col")


def documents(text: str) -> list[dict]:
    """A JSON array of objects; nothing is an empty one."""
    out = json.loads(text) if text and text.strip() else []
    if not isinstance(out, list):
        raise ValueError("a JSON array is needed")
    return out


def providers(text: str) -> list[ProviderSpec]:
    return sorted((ProviderSpec(**{**d, "nk_cols": tuple(d["nk_cols"])}) for d in documents(text)), key=lambda p: (p.topo_level, p.provider_table))


def row_keys(text: str) -> dict[str, list[str]]:
    return {d.get("table", d.get("logical_table")): d.get("row_key_cols", d.get("row_keys")) for d in documents(text)}


def in_scope(name: str, wanted: str) -> bool:
    names = {x.strip().lower() for x in (wanted or "").split(",") if x.strip()}
    return not names or "*" in names or name.lower() in names


@dataclass
class Registry:
    """Roles by key, and how they change state; every change returns the new role."""

    roles: dict[str, ConsumerRole]
    repair_mode: str = "opt_in"

    def discover(self, found: list[ConsumerRole]) -> None:
        first = "SELECTED" if self.repair_mode == "opt_out" else "DISCOVERED"
        for r in found:
            self.roles.setdefault(r.key.lower(), replace(r, repair_status=first))

    def _set(self, key: str, **changes) -> ConsumerRole:
        if key.lower() not in self.roles:
            raise KeyError(f"unknown role: {key}")
        if changes.get("repair_status", REPAIR_STATUSES[0]) not in REPAIR_STATUSES:
            raise ValueError(f"unknown status: {changes['repair_status']}")
        self.roles[key.lower()] = replace(self.roles[key.lower()], **changes)
        return self.roles[key.lower()]

    def status(self, key: str, status: str) -> ConsumerRole:
        return self._set(key, repair_status=status)

    def exclude(self, key: str, reason: str) -> ConsumerRole:
        return self._set(key, repair_status="EXCLUDED", excluded=True, exclusion_reason=reason)

    def classify(self, key: str, kind: str, note: str = "attested") -> ConsumerRole:
        if kind not in CLASSIFICATIONS:
            raise ValueError(f"unknown classification: {kind}")
        notes = " | ".join(x for x in (self.roles[key.lower()].notes, note) if x)
        return self._set(key, classification=kind, notes=notes)

    def triage(self, chosen: list[str], skip_others: bool = False) -> None:
        """The chosen are SELECTED; on demand, the others still DISCOVERED are SKIPPED."""
        if unknown := [k for k in chosen if k.lower() not in self.roles]:
            raise KeyError(f"unknown roles: {unknown}")
        picked = {k.lower() for k in chosen}
        for k, r in self.roles.items():
            if k in picked and r.repair_status not in ("FIXED", "EXCLUDED"):
                self.status(k, "SELECTED")
            elif skip_others and r.repair_status == "DISCOVERED":
                self.status(k, "SKIPPED")

    def eligible(self, purpose: str = "repair") -> list[ConsumerRole]:
        """Roles to repair; validation and promotion also take those that are FIXED."""
        out = []
        for r in self.roles.values():
            passes = r.repair_status in ACTIVE if self.repair_mode == "opt_in" else r.repair_status not in ("SKIPPED", "EXCLUDED", "FIXED")
            if (passes or purpose != "repair" and r.repair_status == "FIXED") and not r.excluded:
                out.append(r)
        return sorted(out, key=lambda r: (r.consumer_table, r.fk_col))

    def validated(self, verdicts: dict[str, list[str]]) -> None:
        """After a run without a FAIL, active roles are VERIFIED; those on the new keys already are FIXED."""
        if any("FAIL" in v for v in verdicts.values()):
            return
        for k in verdicts:
            r = self.roles[k.lower()]
            if r.repair_status in ACTIVE:
                self.status(k, "FIXED" if r.classification == "RELOADED" else "VERIFIED")

    def swept(self, key: str, violations: int) -> None:
        if violations == 0 and self.roles[key.lower()].repair_status in ACTIVE:
            self.status(key, "FIXED")
