"""Conforming of reports: read, clean, check types, map to canonical tables, score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import named
from ledgerloom.operators import clean, validate
from ledgerloom.operators.coverage import kept_reports
from ledgerloom.operators.mapping import (
    JOURNAL_LINE_NUMBER,
    JobError,
    Mapped,
    compile_row,
    empty_column,
)
from ledgerloom.operators.ordinals import dense_ordinal, journal_line_numbers
from ledgerloom.operators.quality import scorecard
from ledgerloom.plans.group import group_trial_balance, write_grouped
from ledgerloom.runtime import durable, literal_rows, scratch_scope
from ledgerloom.sinks.publish import publish
from ledgerloom.sinks.writers import write_scorecard, write_table
from ledgerloom.sources.reports import ORD, SURPLUS, UNCLOSED, read_report, read_report_with_check
from ledgerloom.spec import FileTemplate, MappingRow, ReportSpec, TypedField

_ERRORS, _OK, ROW = "_errors", "_ok", "_row"
NOT_UPLOADED = "The input file was not uploaded"


@dataclass(frozen=True)
class CheckedFile:
    """A validated report file: values and flags of its mapped fields, each cleaned row with its number ``_row``.

    The rows are stored once; the gate, the errors and the tables all read them.
    """

    name: str
    fields: tuple[TypedField, ...]
    rows: DataFrame

    def has_bad_rows(self) -> bool:
        return not self.rows.filter(~validate.all_valid(self.fields)).isEmpty()

    def errors(self, report: str) -> DataFrame:
        return validate.numbered_errors(self.rows, self.fields, report, self.name, ROW)

    def kinds(self) -> dict[str, str]:
        return {f.name: f.data_type for f in self.fields}


@dataclass(frozen=True)
class ConformedReport:
    """Canonical table in mapping order plus ``_ord``, and what went wrong while mapping it.

    ``marked`` holds per file its row number and the array of error marks of each row.
    """

    name: str
    table: DataFrame
    marked: tuple[tuple[str, DataFrame], ...]
    problems: tuple[JobError, ...]

    def canonical(self) -> DataFrame:
        return self.table.drop(ORD)

    def has_errors(self) -> bool:
        """Stops at the first row with an error."""
        return bool(self.problems) or any(
            not rows.filter(F.size(_ERRORS) > 0).isEmpty() for _, rows in self.marked
        )

    @property
    def errors(self) -> DataFrame:
        of_mapping = literal_rows(
            self.table.sparkSession,
            [(self.name, p.target, None, None, None, p.error) for p in self.problems],
            validate.ERROR_SCHEMA,
        )
        of_rows = [_row_errors(rows, self.name, file) for file, rows in self.marked]
        return reduce(lambda a, b: a.unionByName(b), of_rows, of_mapping)


def check_file(raw: DataFrame, name: str, fields: Sequence[TypedField], template: FileTemplate) -> CheckedFile:
    """Exclusion rules, column pruning, row numbers and type checks on a report read by ``read_report``.

    If the report was read with ``surplus`` and ``unclosed``, a row with more cells than the header or an unclosed cell is a bad row.
    """
    df = raw
    if template.exclusion:
        df = clean.exclude_rows(df, template.exclusion, keep=[ORD])
    if template.drop_trailing_total:
        df = clean.drop_trailing_total(df, ORD)
    fields = list(fields)
    for column, kind in ((SURPLUS, validate.SURPLUS_TYPE), (UNCLOSED, validate.UNCLOSED_TYPE)):
        if column in raw.columns and column not in [f.name for f in fields]:
            fields.append(TypedField(column, kind))
    df = clean.prune(df, [f.name for f in fields], keep=[ORD])
    rows = dense_ordinal(validate.validate(df, fields, [ORD]), ORD, ROW, start=1)
    return CheckedFile(name, tuple(fields), durable(rows))


def _mapped_columns(
    report: ReportSpec, files: Mapping[str, CheckedFile]
) -> tuple[dict[str, Mapped], list[JobError], dict[str, Mapped]]:
    """Mapped columns by target, mapping problems, and the journal ids behind each line-number target."""
    found: dict[str, Mapped] = {}
    problems: list[JobError] = []
    journals: dict[str, Mapped] = {}
    for row in report.rows:
        if row.operation == JOURNAL_LINE_NUMBER:
            journals[row.target] = Mapped(f"_journal {row.target}", named(row.sources[0].field_name), None, row.files()[0])
            continue
        single = row.files()[0] if len(row.files()) == 1 else None
        compiled = compile_row(row, files[single].kinds() if single else {})
        if isinstance(compiled, JobError):
            problems.append(compiled)
            compiled = [Mapped(row.target, empty_column(row))]
        for mapped in compiled:
            # A field another operator fills as its extra output is not overwritten by a placeholder.
            if not (row.map_type == "dummy" and mapped.target in found):
                found[mapped.target] = mapped
    return found, problems, journals


def map_report(report: ReportSpec, files: Mapping[str, CheckedFile]) -> ConformedReport:
    """Maps the valid rows of each file.

    Files are put side by side by the number of their cleaned rows, bad ones included, so a bad row shifts nothing; a
    row that is bad in any file is then left out. Journal lines are numbered on what remains.
    """
    if not files:
        raise ValueError(f"report {report.name!r} maps no field of any file")
    mapped, problems, journals = _mapped_columns(report, files)
    targets = [row.target for row in report.rows]
    by_file: dict[str, list[Mapped]] = {name: [] for name in files}
    constants: dict[str, Mapped] = {}
    for target in targets:
        column = journals.get(target) or mapped[target]
        if column.file_name in by_file:
            by_file[column.file_name].append(column)
        else:
            constants[target] = column

    frames, marked = [], []
    for number, (name, columns) in enumerate(by_file.items()):
        rows = files[name].rows.withColumn(_OK, validate.all_valid(files[name].fields))
        values = [F.when(F.col(_OK), c.value).alias(c.target) for c in columns]
        frames.append(rows.select(ROW, F.col(_OK).alias(f"{_OK}{number}"), *values))
        marks = [
            F.when(
                c.error.isNotNull(),
                F.struct(
                    F.lit(c.target).alias("cdm_field"),
                    F.lit(c.field_name).cast("string").alias("field_name"),
                    c.error.alias("error"),
                ),
            )
            for c in columns
            if c.error is not None
        ]
        if marks:
            valid = rows.filter(_OK)
            marked.append((name, valid.select(ROW, F.array_compact(F.array(*marks)).alias(_ERRORS))))

    table = reduce(lambda left, right: left.join(right, ROW, "full_outer"), frames)
    fine = reduce(and_, [F.coalesce(f"{_OK}{n}", F.lit(True)) for n in range(len(frames))])
    table = table.filter(fine).withColumnRenamed(ROW, ORD)
    for target, journal in journals.items():
        if journal.file_name in by_file:
            table = journal_line_numbers(table, journal.target, [ORD], out=target)
    filled = table.select(
        ORD, *[constants[t].value.alias(t) if t in constants else named(t) for t in targets]
    )
    return ConformedReport(report.name, filled, tuple(marked), tuple(problems))


def _row_errors(marked: DataFrame, report: str, file: str) -> DataFrame:
    return marked.select(F.col(ROW).cast("bigint").alias("data_row"), F.inline(_ERRORS)).select(
        F.lit(report).alias("report_name"),
        "cdm_field",
        F.lit(file).alias("file_name"),
        "field_name",
        "data_row",
        "error",
    )


def _read_and_check(
    spark: SparkSession, report: ReportSpec, folder: str
) -> dict[str, CheckedFile]:
    checked = {}
    for name, fields in report.file_fields().items():
        template = report.templates.get(name, FileTemplate())
        file, whole = f"{folder}/{name}", {"multiline": template.multiline, "surplus": True, "unclosed": True}
        if template.header:
            raw = read_report_with_check(spark, file, template.header, **whole)
        else:
            raw = read_report(spark, file, template.start_row, **whole)
        checked[name] = check_file(raw, name, fields, template)
    return checked


def covered_reports(
    spark: SparkSession, reports: Sequence[ReportSpec], uploaded: Sequence[str]
) -> list[ReportSpec]:
    """Reports to process given the uploaded file names; raises when none is left."""
    name, file = T.StructField("report_name", T.StringType()), T.StructField("file_name", T.StringType())
    files = literal_rows(spark, [(f,) for f in uploaded], T.StructType([file]))
    pairs = [(r.name, f) for r in reports for f in r.file_fields()]
    expected = literal_rows(spark, pairs, T.StructType([name, file]))
    kept = {row["report_name"] for row in kept_reports(files, expected).collect()}
    if not kept:
        raise ValueError("Could not find valid mapping from the Standard Mapping")
    return [r for r in reports if r.name in kept]


@dataclass(frozen=True)
class ConformResult:
    status: str
    tables: tuple[str, ...] = ()


def conform(
    spark: SparkSession,
    reports: Sequence[ReportSpec],
    folder: str,
    out: str,
    mode: str = "strict",
    grouping: DataFrame | None = None,
    uploaded: Sequence[str] | None = None,
    as_one: bool = False,
) -> ConformResult:
    """Runs the whole job and writes tables, scorecard and errors below ``out``.

    ``strict``: any error row suppresses every table, and a report with badly typed rows is not mapped.
    ``quarantine``: valid rows are written, errors are written beside them. A kept report with a file that was not
    uploaded is not mapped; the file is an error row. ``as_one`` writes to a run of its own below ``out``, which readers
    find by ``sinks.publish.published`` only once all of it is there.
    """
    if as_one:
        results: list[ConformResult] = []

        def write(folder_of_run: str) -> dict[str, object]:
            results.append(conform(spark, reports, folder, folder_of_run, mode, grouping, uploaded))
            return {"status": results[0].status, "tables": list(results[0].tables)}

        publish(spark, out, write)
        return results[0]
    if uploaded is not None:
        reports = covered_reports(spark, reports, uploaded)
    with scratch_scope(spark):
        return _conform(spark, reports, folder.rstrip("/"), out.rstrip("/"), mode, grouping, uploaded)


def _conform(
    spark: SparkSession,
    reports: Sequence[ReportSpec],
    folder: str,
    out: str,
    mode: str,
    grouping: DataFrame | None,
    uploaded: Sequence[str] | None,
) -> ConformResult:
    conformed: list[tuple[ReportSpec, ConformedReport]] = []
    errors: list[DataFrame] = []
    for report in reports:
        absent = [f for f in report.file_fields() if uploaded is not None and f not in uploaded]
        if absent:
            rows = [(report.name, None, f, None, None, NOT_UPLOADED) for f in absent]
            errors.append(literal_rows(spark, rows, validate.ERROR_SCHEMA))
            continue
        files = _read_and_check(spark, report, folder)
        bad = [f for f in files.values() if f.has_bad_rows()]
        errors += [f.errors(report.name) for f in bad]
        if bad and mode == "strict":
            continue
        result = map_report(report, files)
        conformed.append((report, result))
        if result.has_errors():
            errors.append(result.errors)
    if errors:
        write_table(validate.sorted_errors(*errors), f"{out}/errors.csv")
        if mode == "strict":
            return ConformResult("FAILED")
    cards = []
    for report, result in conformed:
        stored = f"{out}/{report.name}.parquet"
        write_table(result.table, stored, "parquet")
        written = spark.read.parquet(stored)
        write_table(written.drop(ORD), f"{out}/{report.name}.csv")
        declared = [TypedField(row.target, row.data_type) for row in report.rows]
        card = scorecard(written, report.name, declared, ORD)
        if card is not None:
            cards.append(card)
        if report.name == "trialBalance" and grouping is not None:
            write_grouped(group_trial_balance(written.drop(ORD), grouping, True), grouping, out)
    if cards:
        write_scorecard(reduce(lambda a, b: a.unionByName(b), cards), f"{out}/dqs.json")
    return ConformResult("COMPLETED", tuple(report.name for report, _ in conformed))
