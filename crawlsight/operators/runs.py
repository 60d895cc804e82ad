"""Run analytics: counts, pivots, summaries and reports, for any number of runs at once.

Every operator groups by run. Rows are aggregated before they are shuffled, so a
run that holds most of the data costs no single task more than its distinct keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

DETAIL_ROWS = 50  # Fixed value: error rows shown per run.


def requests_by_status(requests: DataFrame) -> DataFrame:
    return requests.groupBy("run_id", "continuation", "status").agg(F.count("*").alias("n"))


def results_by_type(results: DataFrame) -> DataFrame:
    """Valid and invalid rows per type. A missing flag counts as invalid; a type with
    nothing but missing flags has no valid count at all (NULL)."""
    flag = F.col("is_valid").cast("int")
    return results.groupBy("run_id", "result_type").agg(
        F.sum(flag).alias("valid"),
        F.sum(F.when(flag != 0, 0).otherwise(1)).alias("invalid"),
    )


def errors_by_type(errors: DataFrame) -> DataFrame:
    return errors.groupBy("run_id", "error_type").agg(F.count("*").alias("n"))


def errors_total(errors: DataFrame, runs: DataFrame) -> DataFrame:
    """Errors per run, 0 for a run without any."""
    counts = errors.groupBy("run_id").agg(F.count("*").alias("n"))
    return (
        runs.select("run_id")
        .join(counts, "run_id", "left")
        .select("run_id", F.coalesce("n", F.lit(0)).alias("errors"))
    )


def errors_detail_topk(errors: DataFrame, k: int = DETAIL_ROWS) -> DataFrame:
    """The first ``k`` errors of each run by id.

    Spark keeps at most ``k`` rows per run and map task before the shuffle
    (WindowGroupLimit), so a huge run never arrives whole at one task.
    """
    order = Window.partitionBy("run_id").orderBy("id")
    return errors.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def errors_by_continuation(errors: DataFrame, requests: DataFrame) -> DataFrame:
    """Errors per step, found through the request; orphans keep a NULL step.

    Errors are counted per request before the join. That folds repeated errors of
    one request, and all errors without a request, into one row each.
    """
    per_request = errors.groupBy("run_id", "request_id", "error_type").agg(F.count("*").alias("k"))
    steps = requests.select("run_id", F.col("id").alias("request_id"), "continuation")
    return (
        per_request.join(steps, ["run_id", "request_id"], "left")
        .groupBy("run_id", "continuation", "error_type")
        .agg(F.sum("k").alias("n"))
    )


def _joined_counts(pairs: Column) -> Column:
    parts = F.transform(
        F.array_sort(pairs), lambda p: F.concat(p["name"], F.lit("="), p["n"].cast("string"))
    )
    return F.array_join(parts, ", ")


def error_broadcast(errors: DataFrame) -> DataFrame:
    """One line ``type=n, type=n`` per run, by type."""
    counts = errors_by_type(errors).select(
        "run_id", "n", F.struct(text.label(F.col("error_type")).alias("name"), "n").alias("pair")
    )
    return counts.groupBy("run_id").agg(
        F.sum("n").alias("errors"), _joined_counts(F.collect_list("pair")).alias("by_type")
    )


def _labelled(triples: DataFrame, row: str, col: str, n: str) -> DataFrame:
    """Cells with text keys; equal labels are added up."""
    return (
        triples.select(
            "run_id",
            text.label(F.col(row)).alias("row_key"),
            text.label(F.col(col)).alias("col_key"),
            F.col(n).alias("n"),
        )
        .groupBy("run_id", "row_key", "col_key")
        .agg(F.sum("n").alias("n"))
    )


def pivot_counts(triples: DataFrame, row: str, col: str, n: str = "n") -> DataFrame:
    """All cells, row totals, column totals and the grand total of each run's pivot.

    ``kind`` tells them apart, so a key that reads like a total cannot be mistaken for one.
    """
    sets = [["run_id", "row_key", "col_key"], ["run_id", "row_key"], ["run_id", "col_key"], ["run_id"]]
    cells = _labelled(triples, row, col, n)
    grouped = cells.groupingSets(
        [[F.col(name) for name in each] for each in sets], "run_id", "row_key", "col_key"
    ).agg(
        F.sum("n").alias("n"),
        (F.grouping("row_key") * 2 + F.grouping("col_key")).alias("level"),
    )
    kind = (
        F.when(F.col("level") == 0, "cell")
        .when(F.col("level") == 1, "row_total")
        .when(F.col("level") == 2, "col_total")
        .otherwise("grand_total")
    )
    return grouped.select("run_id", kind.alias("kind"), "row_key", "col_key", "n")


def pivot_wide(
    triples: DataFrame, row: str, col: str, columns: Sequence[str], n: str = "n"
) -> DataFrame:
    """The pivot with one column per known key, plus the row total over all keys."""
    cells = _labelled(triples, row, col, n)
    return cells.groupBy("run_id", "row_key").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("col_key") == name, F.col("n"))), F.lit(0)).alias(name)
            for name in columns
        ],
        F.sum("n").alias("total"),
    )


def pivot_markdown(
    triples: DataFrame, row: str, col: str, row_header: str, col_header: str, n: str = "n"
) -> DataFrame:
    """Each run's pivot as one markdown table, with its grand total.

    Zero cells are blank, totals bold. The arrays hold the cells of one table, which
    are distinct labels of a run and never its rows; no joins are needed to lay it out.
    """
    rows = (
        _labelled(triples, row, col, n)
        .groupBy("run_id", "row_key")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("col_key", "n"))).alias("by_col"),
            F.sum("n").alias("total"),
        )
    )
    tables = (
        rows.groupBy("run_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("row_key", "total"))).alias("names"),
            F.map_from_entries(F.collect_list(F.struct("row_key", "by_col"))).alias("lines"),
            F.sum("total").alias("total"),
        )
        .withColumn(
            "cols",
            F.array_sort(
                F.array_distinct(F.flatten(F.transform(F.map_values("lines"), lambda m: F.map_keys(m))))
            ),
        )
    )

    def shown(line: Column, c: Column) -> Column:
        value = F.try_element_at(line, c)
        return F.when(F.coalesce(value, F.lit(0)) == 0, "").otherwise(value.cast("string"))

    def body_line(entry: Column) -> Column:
        line = F.try_element_at(F.col("lines"), entry["row_key"])
        cells = F.array_join(F.transform("cols", lambda c: shown(line, c)), " | ")
        return text.cells(entry["row_key"], cells, text.bold(entry["total"]))

    def col_total(c: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.aggregate(
            F.map_values("lines"), zero, lambda acc, m: acc + F.coalesce(F.try_element_at(m, c), zero)
        )

    head = text.cells(
        F.lit(f"{row_header} \\ {col_header}"), F.array_join("cols", " | "), F.lit("**Total**")
    )
    rule = F.concat(F.lit("| --- |"), F.repeat(F.lit(" --- |"), F.size("cols") + 1))
    foot = text.cells(
        F.lit("**Total**"),
        F.array_join(F.transform("cols", lambda c: text.bold(col_total(c))), " | "),
        text.bold(F.col("total")),
    )
    lines = F.concat(F.array(head, rule), F.transform("names", body_line), F.array(foot))
    return tables.select("run_id", "total", F.array_join(lines, "\n").alias("markdown"))


def requests_total(requests: DataFrame) -> DataFrame:
    return requests.groupBy("run_id").agg(F.count("*").alias("requests"))


def _result_counts(results: DataFrame) -> DataFrame:
    return results_by_type(results).select(
        "run_id",
        "result_type",
        F.coalesce("valid", F.lit(0)).alias("valid"),
        F.coalesce("invalid", F.lit(0)).alias("invalid"),
    )


def results_total(results: DataFrame) -> DataFrame:
    return (
        _result_counts(results)
        .groupBy("run_id")
        .agg(F.sum(F.col("valid") + F.col("invalid")).alias("results"))
    )


def results_table_rows(results: DataFrame) -> DataFrame:
    """Lines of the result table with a total line per run, missing counts as 0."""
    return (
        _result_counts(results)
        .groupingSets(
            [[F.col("run_id"), F.col("result_type")], [F.col("run_id")]], "run_id", "result_type"
        )
        .agg(
            F.grouping("result_type").cast("int").alias("is_total"),
            F.sum("valid").alias("valid"),
            F.sum("invalid").alias("invalid"),
            F.sum(F.col("valid") + F.col("invalid")).alias("total"),
        )
        .select("run_id", "result_type", "is_total", "valid", "invalid", "total")
    )


def run_outcome(runs: DataFrame, errors: DataFrame) -> DataFrame:
    """Label of each finished run. Drained runs have no outcome yet and are left out."""
    return errors_total(errors, runs.where(~F.col("drained"))).withColumn(
        "outcome", F.when(F.col("errors") > 0, "completed with errors").otherwise("completed")
    )


def errors_truncation(errors: DataFrame, runs: DataFrame, k: int = DETAIL_ROWS) -> DataFrame:
    """How many errors of each run the detail list shows and leaves out."""
    return errors_total(errors, runs).select(
        "run_id",
        "errors",
        F.least("errors", F.lit(k)).alias("shown"),
        F.greatest(F.col("errors") - k, F.lit(0)).alias("hidden"),
    )


def run_summary(
    runs: DataFrame, requests: DataFrame, results: DataFrame, errors: DataFrame, k: int = DETAIL_ROWS
) -> DataFrame:
    """All aggregates of a run nested in one row; absent parts are empty arrays.

    The error total and the per-type counts come out of the per-step counts, so
    errors are read twice (counts, detail) instead of four times.
    """
    by_status = (
        requests_by_status(requests)
        .groupBy("run_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("continuation", "status", "n"))).alias(
                "requests_by_status"
            )
        )
    )
    by_type = (
        results_by_type(results)
        .groupBy("run_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("result_type", "valid", "invalid"))).alias(
                "results_by_type"
            )
        )
    )
    steps = errors_by_continuation(errors, requests)
    error_steps = steps.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct("continuation", "error_type", "n"))).alias(
            "errors_by_continuation"
        ),
        F.sum("n").alias("total"),
    )
    error_types = (
        steps.groupBy("run_id", "error_type")
        .agg(F.sum("n").alias("n"))
        .groupBy("run_id")
        .agg(
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct(text.label(F.col("error_type")).alias("t"), "n")))
            ).alias("by_type")
        )
    )
    detail = (
        errors_detail_topk(errors, k)
        .groupBy("run_id")
        .agg(
            F.transform(
                F.array_sort(
                    F.collect_list(
                        F.struct("rank", "error_type", "error_class", "message", "request_url")
                    )
                ),
                lambda e: F.struct(
                    e["error_type"].alias("error_type"),
                    e["error_class"].alias("error_class"),
                    e["message"].alias("message"),
                    e["request_url"].alias("request_url"),
                ),
            ).alias("rows")
        )
    )
    summary = runs.select("run_id")
    for part in (by_status, by_type, error_steps, error_types, detail):
        summary = summary.join(part, "run_id", "left")
    types = {field.name: field.dataType for field in summary.schema.fields}

    def or_empty(name: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast(types[name])).alias(name)

    return summary.select(
        "run_id",
        or_empty("requests_by_status"),
        or_empty("errors_by_continuation"),
        or_empty("results_by_type"),
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce(F.col("by_type"), F.create_map().cast(types["by_type"])).alias("by_type"),
        or_empty("rows"),
    )


def _result_markdown(results: DataFrame) -> DataFrame:
    counts = _result_counts(results)
    total = F.col("valid") + F.col("invalid")
    line = text.cells(
        text.or_none(F.col("result_type")),
        F.col("valid").cast("string"),
        F.col("invalid").cast("string"),
        total.cast("string"),
    )
    grouped = counts.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct("result_type", line.alias("line")))).alias("lines"),
        F.sum(total).alias("results"),
    )
    head = F.array(F.lit("| Type | Valid | Invalid | Total |"), F.lit("| --- | --- | --- | --- |"))
    foot = F.concat(F.lit("| **Total** | | | "), text.bold(F.col("results")), F.lit(" |"))
    return grouped.select(
        "run_id",
        "results",
        F.array_join(
            F.concat(head, F.transform("lines", lambda e: e["line"]), F.array(foot)), "\n"
        ).alias("results_md"),
    )


def _detail_markdown(errors: DataFrame, k: int) -> DataFrame:
    line = text.cells(
        text.or_none(F.col("error_type")),
        text.or_none(F.col("error_class")),
        text.error_text_clean(F.col("message")),
        text.or_none(F.col("request_url")),
    )
    shown = (
        errors_detail_topk(errors, k)
        .groupBy("run_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("lines"))
    )
    head = F.array(F.lit("| Type | Class | Message | URL |"), F.lit("| --- | --- | --- | --- |"))
    return shown.select(
        "run_id",
        F.size("lines").alias("shown"),
        F.array_join(F.concat(head, F.transform("lines", lambda e: e["line"])), "\n").alias("detail_md"),
    )


def run_report(
    runs: DataFrame, requests: DataFrame, results: DataFrame, errors: DataFrame, k: int = DETAIL_ROWS
) -> DataFrame:
    """One markdown document per finished run."""
    status = pivot_markdown(
        requests_by_status(requests), "continuation", "status", "Continuation", "Status"
    )
    steps = pivot_markdown(
        errors_by_continuation(errors, requests),
        "continuation",
        "error_type",
        "Continuation",
        "Error type",
    )
    parts = (
        status.withColumnsRenamed({"total": "requests", "markdown": "requests_md"}),
        _result_markdown(results),
        steps.withColumnsRenamed({"total": "errors", "markdown": "errors_md"}),
        _detail_markdown(errors, k),
    )
    joined = runs.where(~F.col("drained"))
    for part in parts:
        joined = joined.join(part, "run_id", "left")

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def item(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"- **{name}**: "), value)

    def quoted(name: str) -> Column:
        return F.concat(F.lit("`"), text.or_none(F.col(name)), F.lit("`"))

    def section(title: str, body: Column) -> tuple[Column, ...]:
        return (F.lit(""), F.lit(f"## {title}"), F.lit(""), body)

    hidden = count("errors") - count("shown")
    more = F.when(
        hidden > 0,
        F.concat(
            F.lit("\n\n_…and "),
            hidden.cast("string"),
            F.lit(" more (showing first "),
            count("shown").cast("string"),
            F.lit(")._"),
        ),
    ).otherwise("")
    error_body = F.when(
        count("errors") > 0,
        F.concat(F.col("errors_md"), F.lit("\n\n## Error detail\n\n"), F.col("detail_md"), more),
    ).otherwise(text.NO_ERRORS)
    outcome = F.when(count("errors") > 0, "completed with errors").otherwise("completed")
    lines = (
        F.concat(F.lit("# Scrape "), outcome),
        F.lit(""),
        item("Scraper", quoted("source_path")),
        item("Schema", quoted("schema")),
        item("Database", quoted("uri")),
        item("Requests", count("requests").cast("string")),
        item("Results", count("results").cast("string")),
        item("Errors", count("errors").cast("string")),
        *section(
            "Requests by status and continuation",
            F.coalesce(F.col("requests_md"), F.lit(text.NO_REQUESTS)),
        ),
        *section("Results by type", F.coalesce(F.col("results_md"), F.lit(text.NO_RESULTS))),
        *section("Errors by continuation and type", error_body),
    )
    return joined.select("run_id", F.concat(F.concat_ws("\n", *lines), F.lit("\n")).alias("report"))
