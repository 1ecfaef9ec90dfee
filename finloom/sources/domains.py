"""Value lists and ranges that replace a column's default, from a mapping or a YAML/JSON file.

Keys are ``column`` or ``table.column``; the longer key wins. A value is one of

* ``{"values": [...], "weights": [...]}``: a list, for columns drawn from one; weights only where the column draws,
* ``{"min": a, "max": b}``: a range, both ends included, of whole numbers, decimals, reals, ISO dates or fiscal periods,
* ``{"constant": x}``: the one value of a constant column,
* under a key that names two columns, ``code+name``: ``{"pairs": [[code, name], ...], "weights": [...]}``. The second
  column then takes its member from the first one's draw, so the two name the same member in every row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass


KINDS = {"values", "constant", "pairs", "min", "max"}


@dataclass(frozen=True)
class Domain:
    values: tuple = ()
    weights: tuple | None = None
    low: object = None
    high: object = None
    draws_as: str | None = None  # the column whose draw decides, in a pair

    @property
    def is_range(self) -> bool:
        return self.low is not None


def to_domain(entry) -> Domain:
    if isinstance(entry, Domain):
        return entry
    if "values" in entry:
        weights = entry.get("weights")
        return Domain(values=tuple(entry["values"]), weights=tuple(weights) if weights else None)
    if "constant" in entry:
        return Domain(values=(entry["constant"],))
    if entry.get("min") is not None and entry.get("max") is not None:
        return Domain(low=entry["min"], high=entry["max"])
    raise ValueError(f"a domain needs values, a constant, pairs, or min and max: {entry!r}")


def paired_domains(name: str, entry: Mapping) -> dict[str, Domain]:
    """The two domains of a ``code+name`` key (``table.code+name`` for one table)."""
    table, _, columns = name.rpartition(".")
    code, plus, label = columns.partition("+")
    pairs, weights = entry["pairs"], entry.get("weights")
    if not (code and plus and label) or not pairs or any(len(pair) != 2 for pair in pairs):
        raise ValueError(f"pairs need a key code+name and two values each: {name!r}: {entry!r}")
    weights = tuple(weights) if weights else None
    prefix = f"{table}." if table else ""
    return {prefix + code: Domain(tuple(first for first, _ in pairs), weights),
            prefix + label: Domain(tuple(second for _, second in pairs), weights, draws_as=code)}


def load_mapping(path: str) -> dict:
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            return json.load(handle)
        try:
            import yaml
        except ImportError as missing:
            raise ImportError("reading YAML needs PyYAML; use a .json file instead") from missing
        return yaml.safe_load(handle)


def read_domains(source) -> dict[str, Domain]:
    """Domains from a mapping, a file path or nothing. A top-level ``domains`` key is allowed."""
    if source is None:
        return {}
    entries = source if isinstance(source, Mapping) else load_mapping(source)
    entries = entries.get("domains", entries)
    found = {}
    for name, entry in entries.items():
        if isinstance(entry, Mapping) and not KINDS & set(entry):
            found.update(read_domains({"domains": entry}))
        elif isinstance(entry, Mapping) and "pairs" in entry:
            found.update(paired_domains(name, entry))
        else:
            found[name] = to_domain(entry)
    return found
