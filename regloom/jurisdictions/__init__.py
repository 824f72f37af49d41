"""Shipped jurisdictions: layout and mapping rules by code."""

from __future__ import annotations

from regloom.jurisdictions import im, us_fl
from regloom.plans.layout import Layout
from regloom.plans.rules import MappingRules

_RULES = {"us_fl": us_fl.mapping_rules, "im": im.mapping_rules}
_LAYOUTS = {"us_fl": us_fl.layout}


def rules_for(jurisdiction: str) -> MappingRules:
    if jurisdiction not in _RULES:
        raise ValueError(f"no mapping rules for jurisdiction {jurisdiction!r}")
    return _RULES[jurisdiction]()


def layout_for(jurisdiction: str) -> Layout:
    if jurisdiction not in _LAYOUTS:
        raise ValueError(f"no fixed-width layout for jurisdiction {jurisdiction!r}")
    return _LAYOUTS[jurisdiction]()
