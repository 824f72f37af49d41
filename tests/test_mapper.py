import json
import random
import re
from datetime import datetime
from enum import Enum

import pytest
from pyspark.sql import functions as F

from regloom.jurisdictions import im, rules_for
from regloom.operators.schema import encode_json
from regloom.plans.compiler import compile_rules, map_to_cdm
from regloom.plans.model import CDM, CDM_FIELDS, target_model
from regloom.plans.rules import MappingRule, MappingRules, Strategy


def make_rules(rules):
    return MappingRules.from_dict({"meta_data": {"file_name": "test", "version": "1.0"}, "rules": rules})


def mapped(spark, rows, rules, model, metadata=None):
    """Records as plain dicts, without absent members."""
    names = list(dict.fromkeys(k for r in rows for k in r))
    schema = ", ".join(f"`{n}` string" for n in names)
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    out = encode_json(map_to_cdm(df, make_rules(rules) if isinstance(rules, dict) else rules, metadata, model))
    result = []
    for row in out.collect():
        record = row.asDict()
        result.append({k: json.loads(v) if v is not None and v[:1] in "[{" else v for k, v in record.items()})
    return result


OFFICERS = {"cdm_field": "officers", "value_type": "dict", "strategy": "add"}
RA_NAME = {
    "source_field": "RA_NAME", "cdm_parent": "officers", "cdm_field": "name",
    "pattern_group": "RA_", "pattern": "(RA_)NAME", "strategy": "regex",
}
RA_POSITION = {
    "literal_value": "agent", "cdm_parent": "officers", "cdm_field": "position",
    "strategy": "literal", "pattern_group": "RA_",
}
RA_OTHER = {
    "cdm_field": "other_attributes", "cdm_parent": "officers", "value_type": "dict",
    "strategy": "find_regex_parent", "pattern_group": "RA_",
}
RA_TYPE = {
    "source_field": "RA_NAME_TYPE", "cdm_parent": "other_attributes", "cdm_field": "type",
    "strategy": "find_regex_parent", "pattern_group": "RA_",
}


def ra(part, attribute):
    return {
        "source_field": f"RA_{part}", "cdm_parent": "officers", "cdm_field": attribute,
        "pattern_group": "RA_", "pattern": f"(RA_){part}", "strategy": "regex",
    }


def princ(part, attribute, parent="officers", strategy="regex"):
    return {
        "source_field": rf"PRINC(\d)_{part}", "cdm_parent": parent, "cdm_field": attribute,
        "pattern_group": 1, "pattern": rf"PRINC(\d)_{part}", "strategy": strategy,
    }


def test_copy(spark):
    """Columns in another order than their targets, one of them under a name with a blank and a quote."""
    rules = {"ship": {"source_field": "Ship's name", "cdm_field": "name"}, "port": {"source_field": "port", "cdm_field": "home"}}
    rows = [{"port": "Kiel", "Ship's name": "Anna"}, {"port": "", "Ship's name": "B \u00e9"}]
    assert mapped(spark, rows, rules, ["name", "home", "flag"]) == [
        {"name": "Anna", "home": "Kiel", "flag": None},
        {"name": "B \u00e9", "home": None, "flag": None},
    ]


def test_copy_keeps_the_first_source(spark):
    rules = {
        "a": {"source_field": "f1", "cdm_field": "x"},
        "b": {"source_field": "f2", "cdm_field": "x"},
    }
    rows = [{"f1": "1", "f2": "2"}, {"f1": "", "f2": "2"}, {"f1": None, "f2": ""}]
    assert [r["x"] for r in mapped(spark, rows, rules, ["x"])] == ["1", "2", None]


def test_literal_needs_a_non_empty_cell_and_beats_a_copy(spark):
    rules = {
        "a": {"literal_value": "ABC", "cdm_field": "x", "strategy": "literal"},
        "b": {"source_field": "f", "cdm_field": "x"},
    }
    assert [r["x"] for r in mapped(spark, [{"f": "1"}, {"f": ""}], rules, ["x"])] == ["ABC", None]
    other = mapped(spark, [{"f": "", "unmapped": "u"}], rules, ["x"])
    assert other[0]["x"] == "ABC"


def test_group_literal(spark):
    """The literal joins its group wherever the group holds anything, and makes none of its own."""
    crew = {"cdm_field": "crew", "value_type": "dict", "strategy": "add"}
    rules = {
        "crew": crew,
        "rank": {"literal_value": "master", "cdm_parent": "crew", "cdm_field": "rank", "strategy": "literal", "pattern_group": "CAP"},
        "born": {"cdm_parent": "crew", "cdm_field": "born", "pattern_group": "CAP", "pattern": "(CAP)_YEAR", "strategy": "regex"},
        "cook": {"cdm_parent": "crew", "cdm_field": "born", "pattern_group": "COOK", "pattern": "(COOK)_YEAR", "strategy": "regex"},
    }
    rows = [{"CAP_YEAR": "1970", "COOK_YEAR": "1980"}, {"CAP_YEAR": "", "COOK_YEAR": "1981"}, {"CAP_YEAR": None, "COOK_YEAR": ""}]
    got = [r["crew"] for r in mapped(spark, rows, rules, ["crew"])]
    # A cell of the row is enough for a literal, so the second row's captain has a rank but no year.
    assert got[0] == {"CAP": {"rank": "master", "born": "1970"}, "COOK": {"born": "1980"}}
    assert got[1]["COOK"] == {"born": "1981"} and got[2] is None


def test_nested_copy(spark):
    rules = {
        "1": {"cdm_field": "cdm_field1", "value_type": "dict", "strategy": "add"},
        "2": {"cdm_field": "cdm_field2", "value_type": "dict", "strategy": "add"},
        "3": {"source_field": "field3", "cdm_parent": "cdm_field2", "cdm_field": "cdm_field3"},
    }
    got = mapped(spark, [{"field1": "value1", "field3": "value3"}], rules, ["cdm_field1", "cdm_field2"])
    assert got == [{"cdm_field1": None, "cdm_field2": {"cdm_field3": "value3"}}]


def test_two_levels(spark):
    """A parent inside a parent, with a sibling value on the first level; neither is made from empty cells."""
    rules = {
        "hull": {"cdm_field": "hull", "value_type": "dict", "strategy": "add"},
        "engine": {"cdm_parent": "hull", "cdm_field": "engine", "value_type": "dict", "strategy": "add"},
        "power": {"source_field": "kw", "cdm_parent": "engine", "cdm_field": "power"},
        "length": {"source_field": "len", "cdm_parent": "hull", "cdm_field": "length"},
    }
    rows = [{"kw": "900", "len": "40"}, {"kw": "", "len": "41"}, {"kw": "7", "len": None}, {"kw": None, "len": ""}]
    assert [r["hull"] for r in mapped(spark, rows, rules, ["hull"])] == [
        {"engine": {"power": "900"}, "length": "40"}, {"length": "41"}, {"engine": {"power": "7"}}, None,
    ]


def test_unknown_target_is_ignored(spark):
    rules = {"3": {"source_field": "field3", "cdm_field": "cdm_field3"}}
    assert mapped(spark, [{"field3": "x"}], rules, ["other"]) == [{"other": None}]
    assert compile_rules(["field3"], make_rules(rules), target_model(["other"])).warnings


def test_regex_groups(spark):
    """Groups named by what the pattern captures, in any number, also letters; other columns stay out."""
    rules = {
        "holds": {"cdm_field": "holds", "value_type": "dict", "strategy": "add"},
        "tons": {"cdm_parent": "holds", "cdm_field": "tons", "pattern_group": 1, "pattern": r"HOLD_(\w)_TONS", "strategy": "regex"},
        "cargo": {"cdm_parent": "holds", "cdm_field": "cargo", "pattern_group": 1, "pattern": r"HOLD_(\w)_CARGO", "strategy": "regex"},
    }
    row = {"HOLD_A_TONS": "12", "HOLD_B_TONS": "", "HOLD_B_CARGO": "grain", "HOLD_7_TONS": "3", "HOLDS": "9", "HOLD_A_CARGO": None}
    got = mapped(spark, [row], rules, ["holds"])[0]["holds"]
    assert got == {"A": {"tons": "12"}, "B": {"cargo": "grain"}, "7": {"tons": "3"}}


def test_agent_with_nested_type(spark):
    """A value one level below its group; without it the group has no such level."""
    rules = {"officers": OFFICERS, "n": RA_NAME, "o": RA_OTHER, "t": RA_TYPE, "c": ra("CITY", "city")}
    rows = [
        {"RA_NAME": "Harbour Trust", "RA_NAME_TYPE": "X", "RA_CITY": ""},
        {"RA_NAME": "", "RA_NAME_TYPE": "Y", "RA_CITY": "Bergen"},
        {"RA_NAME": "O\"Hara", "RA_NAME_TYPE": "", "RA_CITY": "Cork"},
    ]
    assert [r["officers"]["RA_"] for r in mapped(spark, rows, rules, ["officers"])] == [
        {"name": "Harbour Trust", "other_attributes": {"type": "X"}},
        {"other_attributes": {"type": "Y"}, "city": "Bergen"},
        {"name": "O\"Hara", "city": "Cork"},
    ]


def test_two_principals_and_an_agent(spark):
    """Groups of both kinds side by side; a group of empty cells is left out, and so are all other columns."""
    rules = {
        "officers": OFFICERS, "n": RA_NAME, "p": RA_POSITION, "o": RA_OTHER, "t": RA_TYPE,
        "pn": princ("NAME", "name"), "pz": princ("ZIP5", "zip5"),
        "po": {**RA_OTHER, "pattern_group": 1}, "pk": princ("KIND", "kind", "other_attributes", "find_regex_parent"),
    }
    row = {"RA_NAME": "Quay & Sons", "RA_NAME_TYPE": "", "PRINC3_NAME": "Ida", "PRINC3_KIND": "owner", "PRINC5_ZIP5": "00501"}
    row |= {"PRINC4_NAME": None, "PRINC4_KIND": "", "PRINC4_ZIP5": "", "unmapped": "u"}
    got = mapped(spark, [row], rules, CDM)[0]
    assert got.pop("officers") == {
        "RA_": {"name": "Quay & Sons", "position": "agent"},
        "3": {"name": "Ida", "other_attributes": {"kind": "owner"}},
        "5": {"zip5": "00501"},
    }
    assert set(got) == set(CDM_FIELDS) - {"officers"} and not any(got.values())


def test_dates(spark):
    def date(parent, source, name):
        return {
            "cdm_parent": parent, "source_field": source, "cdm_field": name, "value_type": "date",
            "date_format": "MMDDYYYY", "python_date_format": "%m%d%Y", "strategy": "add",
        }

    rules = {
        "i": {"cdm_field": "incorporation_date", "value_type": "dict", "strategy": "add"},
        "ie": date("incorporation_date", "COR_FILE_DATE", "cor_file_date"),
        "d": {"cdm_field": "dissolution_date", "value_type": "dict", "strategy": "add"},
        "de": date("dissolution_date", "COR_DISS_DATE", "cor_diss_date"),
    }
    rows = [{"COR_DISS_DATE": None, "COR_FILE_DATE": d} for d in ("01022024", "132021", "99999999")]
    got = mapped(spark, rows, rules, ["incorporation_date", "dissolution_date"])
    values = [r["incorporation_date"]["cor_file_date"] for r in got]
    assert [v["value"] for v in values] == ["01022024", "01032021", "99999999"]
    assert all(v["format"] == "MMDDYYYY" and v["python_date_format"] == "%m%d%Y" for v in values)
    assert all(r["dissolution_date"] is None for r in got)


def test_literals_in_a_parent(spark):
    """Two literals under one parent; one of them names a source it does not need.  The model is an enumeration."""

    class Model(Enum):
        papers = "papers"
        yard = "yard"

    rules = {
        "papers": {"cdm_field": "papers", "value_type": "dict", "strategy": "add"},
        "issuer": {"source_field": "nowhere", "cdm_parent": "papers", "cdm_field": "issuer", "literal_value": "port office", "strategy": "literal"},
        "form": {"literal_value": "7b", "cdm_parent": "papers", "cdm_field": "form", "strategy": "literal"},
        "yard": {"source_field": "built at", "cdm_field": "yard"},
    }
    got = mapped(spark, [{"built at": "Gdansk"}, {"built at": ""}], rules, Model)
    assert got == [{"papers": {"issuer": "port office", "form": "7b"}, "yard": "Gdansk"}, {"papers": None, "yard": None}]


def test_metadata_is_laid_over_the_empty_model(spark):
    rules = {"a": {"source_field": "f", "cdm_field": "hash"}, "n": {"source_field": "g", "cdm_field": "name"}}
    meta = {"hash": "from file", "source_name": None, "fetched_by": "me"}
    got = mapped(spark, [{"f": "row", "g": "x"}], rules, ["name", "hash"], meta)
    assert got == [{"name": "x", "hash": "from file", "source_name": None, "fetched_by": "me"}]


def test_mistakes_in_rules():
    model = target_model(["officers", "x"])
    with pytest.raises(ValueError, match="cdm_field"):
        MappingRule.from_dict({"cdm_parent": "field1"})
    with pytest.raises(ValueError):
        MappingRule.from_dict({"cdm_field": "a", "strategy": "copy"})
    with pytest.raises(ValueError, match="more than one"):
        compile_rules(["PRINC1_NAME"], make_rules({"o": OFFICERS, "a": {**princ("NAME", "n"), "source_field": None}, "b": {**princ("NAM", "m"), "source_field": None}}), model)
    with pytest.raises(ValueError, match="not defined"):
        compile_rules(["f"], make_rules({"a": {"source_field": "f", "cdm_parent": "nope", "cdm_field": "b"}}), model)
    with pytest.raises(ValueError, match="pattern_group"):
        compile_rules(["f"], make_rules({"a": {"source_field": "f", "cdm_parent": "officers", "cdm_field": "b", "strategy": "find_regex_parent"}}), model)
    with pytest.raises(ValueError, match="no parent rule"):
        rules = make_rules({"o": RA_OTHER, "t": {**RA_TYPE, "pattern_group": "1"}})
        rules.parent_of(rules.rules["t"])


def test_parent_of_prefers_the_same_group():
    rules = make_rules({"a": RA_OTHER, "b": {**RA_OTHER, "pattern_group": 1}, "t": {**RA_TYPE, "pattern_group": "1"}})
    assert rules.parent_of(rules.rules["t"]) is rules.rules["b"]


def test_date_fields():
    assert rules_for("us_fl").date_fields() == ["incorporation_date"]
    rules = make_rules(
        {
            "a": {"cdm_parent": "p", "cdm_field": "f", "value_type": "date"},
            "b": {"cdm_parent": "q", "cdm_field": "f", "value_type": "date"},
            "c": {"cdm_parent": "p", "cdm_field": "g", "value_type": "date"},
            "d": {"cdm_field": "f", "value_type": "date"},
            "e": {"cdm_field": "h", "value_type": "dict"},
        }
    )
    assert rules.date_fields() == ["p", "q", "f"]


def test_us_fl_name_type_stands_in_for_a_missing_name(spark):
    rows = [{"PRINC1_NAME_TYPE": "P", "PRINC1_NAME": "DOE"}, {"PRINC1_NAME_TYPE": "P", "PRINC1_NAME": ""}]
    got = mapped(spark, rows, rules_for("us_fl"), CDM)
    assert [r["officers"]["1"]["name"] for r in got] == ["DOE", "P"]


def test_isle_of_man_json_lines(spark):
    lines = [
        {
            "Number": "030752B", "Name": "Home", "Status": "Live", "Date of Registration": "3 Oct 2024",
            "Place of Business": "LAXEY", "Documents": "2", "Previous Names": [{"Name": "H", "Status": "Current"}],
        },
        {"Number": "1", "Registered Agents": [{"Agent": "A", "Address": "B"}], "Date of Incorporation": "31 Feb 2024"},
    ]
    text = spark.createDataFrame([(json.dumps(x),) for x in lines], "value string")
    df = text.select(F.from_json("value", im.source_schema()).alias("v")).select("v.*")
    got = [r.asDict() for r in encode_json(map_to_cdm(df, rules_for("im"))).collect()]
    assert json.loads(got[0]["incorporation_date"]) == {
        "date_of_registration": {"value": "03 Oct 2024", "format": "DD Mon YYYY", "python_date_format": "%d %b %Y"}
    }
    assert json.loads(got[0]["previous_names"]) == [{"Name": "H", "Status": "Current"}]
    assert json.loads(got[0]["registered_address"]) == {"place_of_business": "LAXEY"}
    assert json.loads(got[1]["officers"]) == [{"Agent": "A", "Address": "B"}]
    assert got[1]["previous_names"] is None and got[1]["jurisdiction_code"] == "im"


# --- a model of the mapping, one row at a time, to compare random rule sets with ---


class RowModel:
    def __init__(self, rules, model):
        self.rules, self.model = list(rules.rules.values()), model
        self.lookup = rules

    def rule(self, column):
        exact = [r for r in self.rules if r.source_field == column]
        if exact:
            return exact[0]
        keyed = (Strategy.REGEX, Strategy.FIND_REGEX_PARENT)
        found = [r for r in self.rules if r.pattern and r.strategy in keyed and re.match(r.pattern, column)]
        return found[0] if found else None

    def run(self, row):
        record = {f: None for f in self.model.fields}
        placed = set()
        for column, cell in row.items():
            if not cell:
                continue
            self.cell(record, column, cell)
            for i, rule in enumerate(self.rules):
                if rule.strategy is not Strategy.LITERAL or i in placed:
                    continue
                if rule.pattern_group:
                    group = (record.get(rule.cdm_parent) or {}).get(rule.pattern_group)
                    if group is not None:
                        group[rule.cdm_field] = rule.literal_value
                        placed.add(i)
                elif rule.cdm_parent:
                    self.below(record, rule.cdm_parent)[rule.cdm_field] = rule.literal_value
                else:
                    record[rule.cdm_field] = rule.literal_value
        return record

    @staticmethod
    def below(node, key):
        if node.get(key) is None:
            node[key] = {}
        return node[key]

    def cell(self, record, column, cell):
        rule = self.rule(column)
        if rule is None or rule.strategy is Strategy.LITERAL:
            return
        if rule.strategy in (Strategy.COPY, Strategy.ADD):
            value = self.value(rule, cell)
            if rule.cdm_parent:
                self.below(record, rule.cdm_parent)[rule.cdm_field] = value
            elif record[rule.cdm_field] is None:
                record[rule.cdm_field] = value
            return
        captured = re.match(rule.pattern, column).group(1) if rule.pattern else str(rule.pattern_group)
        if rule.cdm_parent in record:
            self.below(self.below(record, rule.cdm_parent), captured)[rule.cdm_field] = cell
        else:
            group = self.below(self.below(record, "officers"), captured)
            self.below(group, rule.cdm_parent)[rule.cdm_field] = cell

    @staticmethod
    def value(rule, cell):
        if not rule.python_date_format:
            return cell
        try:
            cell = datetime.strptime(cell, rule.python_date_format).strftime(rule.python_date_format)
        except ValueError:
            pass
        return {"value": cell, "format": rule.date_format, "python_date_format": rule.python_date_format}


def random_rules(rng):
    rules = {
        "officers": OFFICERS, "o1": RA_OTHER, "o2": {**RA_OTHER, "pattern_group": 1},
        "dates": {"cdm_field": "dates", "value_type": "dict", "strategy": "add"},
        "attrs": {"cdm_field": "attrs", "value_type": "dict", "strategy": "add"},
    }
    columns = ["A", "B", "C", "D", "D1", "D2"]
    for c in columns[:4]:
        kind = rng.choice(["top", "attr", "none"])
        if kind == "top":
            rules[c] = {"source_field": c, "cdm_field": rng.choice(["x", "y"])}
        elif kind == "attr":
            rules[c] = {"source_field": c, "cdm_parent": "attrs", "cdm_field": rng.choice(["p", "q"])}
    for c in columns[4:]:
        rules[c] = {
            "source_field": c, "cdm_parent": "dates", "cdm_field": rng.choice(["d", c]), "value_type": "date",
            "date_format": "F", "python_date_format": "%m%d%Y", "strategy": "add",
        }
    for part in ("NAME", "CITY", "POS"):
        if rng.random() < 0.8:
            rules[f"ra{part}"] = ra(part, rng.choice([part.lower(), "position"]))
        if rng.random() < 0.8:
            rules[f"pr{part}"] = princ(part, rng.choice([part.lower(), "name"]))
    if rng.random() < 0.8:
        rules["raT"] = {**RA_TYPE, "source_field": "RA_TYPE"}
    if rng.random() < 0.8:
        rules["prT"] = princ("TYPE", "type", "other_attributes", rng.choice(["regex", "find_regex_parent"]))
        rules["prU"] = princ("KIND", "kind", "other_attributes", "find_regex_parent")
    if rng.random() < 0.7:
        rules["lit1"] = {"literal_value": "L", "cdm_field": rng.choice(["x", "z"]), "strategy": "literal"}
    if rng.random() < 0.7:
        rules["lit2"] = {"literal_value": "M", "cdm_parent": "attrs", "cdm_field": rng.choice(["p", "m"]), "strategy": "literal"}
    if rng.random() < 0.7:
        rules["lit3"] = RA_POSITION
    return rules


@pytest.mark.parametrize("seed", range(12))
def test_random_rules_equal_the_row_model(spark, seed):
    rng = random.Random(seed)
    rules = make_rules(random_rules(rng))
    model = target_model(["x", "y", "z", "dates", "attrs", "officers"])
    columns = ["A", "B", "C", "D", "D1", "D2", "U"]
    columns += [f"RA_{p}" for p in ("NAME", "CITY", "POS", "TYPE")]
    columns += [f"PRINC{n}_{p}" for n in (1, 2) for p in ("NAME", "CITY", "POS", "TYPE", "KIND", "NAME_TYPE")]
    rng.shuffle(columns)
    dates = ["132021", "01022024", "99", "02302020"]
    density = [0.1, 0.4, 0.9, 0.0]
    rows = [
        {c: (rng.choice(dates) if c in ("D1", "D2") else f"{c}-{i}") if rng.random() < density[i % 4] else rng.choice(["", None]) for c in columns}
        for i in range(60)
    ]
    assert mapped(spark, rows, rules, model) == [RowModel(rules, model).run(r) for r in rows]


def test_mapping_is_one_narrow_projection(spark):
    from regloom.jurisdictions import layout_for

    df = spark.createDataFrame([], ", ".join(f"{n} string" for n in layout_for("us_fl").names + ["hash"]))
    plan = map_to_cdm(df, rules_for("us_fl"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
