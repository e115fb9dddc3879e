"""Settings and category rules from YAML."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields
from pathlib import Path

from ledgerloom.errors import ContractError
from ledgerloom.functions.rules import Rule, make_rule, sort_rules

CONFIGS = Path(__file__).resolve().parent.parent / "configs"


@dataclass(frozen=True)
class Settings:
    database: str
    transfer_window_days: int = 4
    anomaly_z_threshold: float = 3.0
    anomaly_window_days: int = 90
    anomaly_min_history: int = 5
    catalog: str = ""

    def __post_init__(self) -> None:
        if not all(re.fullmatch(r"[A-Za-z0-9_]+", part) for part in self.namespace.split(".")):
            raise ContractError(f"catalog and database {self.namespace!r} must be plain names parted by dots")
        least = {"transfer_window_days": 0, "anomaly_window_days": 1, "anomaly_min_history": 2}
        for name, low in least.items():
            if getattr(self, name) < low:
                raise ContractError(f"{name} must be {low} at least")

    @property
    def namespace(self) -> str:
        """The database, in its catalog if one is named."""
        return f"{self.catalog}.{self.database}" if self.catalog else self.database

    def table(self, name: str) -> str:
        return f"{self.namespace}.{name}"


def _mapping(path: Path) -> dict:
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(data, dict):
        raise ContractError(f"{path}: must be a mapping")
    return data


def load_settings(path: Path | None = None, **given) -> Settings:
    """From YAML, with the given values that aren't None over them."""
    data = _mapping(path or CONFIGS / "settings.yml") | {k: v for k, v in given.items() if v is not None}
    kinds = {f.name: {"str": str, "int": int, "float": float}[f.type] for f in fields(Settings)}
    if odd := sorted(set(data) - set(kinds)):
        raise ContractError(f"settings that aren't known: {', '.join(odd)}")
    if not data.get("database"):
        raise ContractError("settings: database is missing")
    return Settings(**{k: kinds[k](v) for k, v in data.items()})


def load_rules(path: Path | None = None) -> list[Rule]:
    entries = _mapping(path or CONFIGS / "rules.yml").get("rules")
    if not entries or not isinstance(entries, list):
        raise ContractError("rules: must be a list with at least one rule")
    return sort_rules(map(make_rule, entries))
