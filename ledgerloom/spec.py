"""Control data of the jobs: mapping rows, file templates, exclusion rules and analysis steps.

Everything here is small driver-side configuration. ``from_dict`` accepts the JSON shape in which mapping
files and step lists are exchanged.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

NUMERIC_TYPES = ("decimal", "number", "integer")
DATE_TYPES = ("date", "datetime")


@dataclass(frozen=True)
class SourceField:
    file_name: str
    field_name: str
    order: int | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> SourceField:
        order = raw.get("order")
        return cls(raw["file_name"], raw["field_name"], None if order is None else int(order))


@dataclass(frozen=True)
class CodeSplit:
    opening_char: str
    closing_char: str
    inside_outside: str


@dataclass(frozen=True)
class AccountRange:
    start: float
    end: float
    negatives: str


@dataclass(frozen=True)
class MappingRow:
    map_type: str
    target: str
    report_type: str
    data_type: str
    sources: tuple[SourceField, ...] = ()
    operation: str | None = None
    free_text: str | None = None
    expression: str = ""
    date_format: str | None = None
    characters: int | None = None
    extra: str | None = None
    code_split: CodeSplit | None = None
    ranges: tuple[AccountRange, ...] = ()
    file_name: str | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> MappingRow:
        split = raw.get("extract_split_fields")
        extra = raw.get("extra")
        characters = raw.get("characters")
        return cls(
            map_type=raw["map_type"],
            target=raw["cdm_field"],
            report_type=raw["report_type"],
            data_type=raw["data_type"],
            sources=tuple(SourceField.from_dict(s) for s in raw.get("erp_fields") or ()),
            operation=raw.get("operation"),
            free_text=raw.get("free_text"),
            expression=raw.get("expression") or "",
            date_format=raw.get("date_format"),
            characters=int(characters) if characters not in (None, "") else None,
            extra=None if extra in (None, "", "-1") else extra,
            code_split=CodeSplit(
                split["opening_char"], split.get("closing_char", ""), split["inside_outside"]
            )
            if split
            else None,
            ranges=tuple(
                AccountRange(float(r["start"]), float(r["end"]), r["negatives"])
                for r in raw.get("rangeDetails") or ()
            ),
            file_name=raw.get("file_name"),
        )

    def ordered_sources(self) -> tuple[SourceField, ...]:
        if any(s.order is None for s in self.sources):
            return self.sources
        return tuple(sorted(self.sources, key=lambda s: s.order))

    def files(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(s.file_name for s in self.sources))


@dataclass(frozen=True)
class ExclusionRule:
    column: int
    contains: str


@dataclass(frozen=True)
class Exclusion:
    rules: tuple[ExclusionRule, ...]
    aggr: str = "or"

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Exclusion:
        rules = tuple(ExclusionRule(int(r["column"]), r["contains"]) for r in raw["rules"])
        return cls(rules, raw.get("aggr", "or"))


@dataclass(frozen=True)
class HeaderCheck:
    """What a header line must hold: the source columns of each canonical field, and how many of them at least."""

    columns: Mapping[str, tuple[str, ...]]
    occurrences: Mapping[str, int]

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> HeaderCheck:
        """From an input file's declared ``fields`` and ``mandatory_field_check``."""
        columns: dict[str, list[str]] = {}
        for declared in raw["fields"]:
            for target in declared.get("cdm_field_names") or ():
                columns.setdefault(target, []).append(declared["field_name"])
        wanted = {r["cdm_field_name"]: int(r["occurrence_count"]) for r in raw["mandatory_field_check"]}
        return cls({t: tuple(c) for t, c in columns.items()}, wanted)


@dataclass(frozen=True)
class FileTemplate:
    """With ``header`` the header is the first line that meets the check, wherever it stands; else it is at ``start_row``."""

    start_row: int = 1
    exclusion: Exclusion | None = None
    drop_trailing_total: bool = False
    multiline: bool = True
    header: HeaderCheck | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> FileTemplate:
        exclusion = raw.get("exclusion")
        return cls(int(raw["start_row"]), Exclusion.from_dict(exclusion) if exclusion else None)


@dataclass(frozen=True)
class TypedField:
    name: str
    data_type: str


@dataclass(frozen=True)
class ReportSpec:
    """One canonical table: its mapping rows and the template of every input file."""

    name: str
    rows: tuple[MappingRow, ...]
    templates: Mapping[str, FileTemplate] = field(default_factory=dict)

    def file_fields(self) -> dict[str, tuple[TypedField, ...]]:
        """Source fields per file; the first declared type of a field wins."""
        found: dict[str, dict[str, str]] = {}
        for row in self.rows:
            for source in row.sources:
                found.setdefault(source.file_name, {}).setdefault(source.field_name, row.data_type)
        return {
            file: tuple(TypedField(name, kind) for name, kind in fields.items())
            for file, fields in found.items()
        }


def reports_from_mapping(
    mapping: Mapping[str, Iterable[Mapping[str, Any]]],
    templates: Mapping[str, FileTemplate] | None = None,
) -> list[ReportSpec]:
    """Groups the rows of a mapping file by report, keeping their order."""
    grouped: dict[str, list[MappingRow]] = {}
    for rows in mapping.values():
        for raw in rows:
            row = MappingRow.from_dict(raw)
            grouped.setdefault(row.report_type, []).append(row)
    return [ReportSpec(name, tuple(rows), dict(templates or {})) for name, rows in grouped.items()]


def templates_from_extract(extract: Mapping[str, Any], find_headers: bool = False) -> dict[str, FileTemplate]:
    """File templates of one extract, keyed by uploaded name ``<report>_<file>``.

    With ``find_headers``, files with a declared field check are searched for their header line.
    """

    def template(item: Mapping[str, Any]) -> FileTemplate:
        found = FileTemplate.from_dict(item["template"])
        checked = find_headers and item.get("mandatory_field_check")
        return replace(found, header=HeaderCheck.from_dict(item)) if checked else found

    return {
        f"{report['report_type']}_{item['file_name']}": template(item)
        for report in extract["reports"]
        for item in report["input_files"]
    }


@dataclass(frozen=True)
class Condition:
    column: str
    comparison: str = ""
    input: str = ""
    unique: bool = False

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Condition:
        return cls(
            raw.get("filter_column") or "",
            raw.get("filter_condition") or "",
            "" if raw.get("input") is None else str(raw["input"]),
            bool(raw.get("is_unique")),
        )


@dataclass(frozen=True)
class Step:
    order: str
    kind: str
    source: str = ""
    conditions: tuple[Condition, ...] = ()
    relation: str = "and"

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Step:
        return cls(
            str(raw["order"]),
            raw["operation_type"],
            str(raw.get("source") or ""),
            tuple(Condition.from_dict(c) for c in raw.get("conditions") or ()),
            raw.get("relation") or "and",
        )


def steps_from_config(config: Mapping[str, Any]) -> list[Step]:
    return [Step.from_dict(raw) for raw in config["operation"]]
