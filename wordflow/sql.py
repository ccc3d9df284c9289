"""The library's functions for SQL, as SQL functions of the session without Python workers."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Each body is an expression or a query that Catalyst puts in place of the call.
SCALARS = {
    "keyed_line(k string, v string) returns string": "concat(coalesce(k, ''), ' ', coalesce(v, ''))",
    "value_line(v string) returns string": "coalesce(v, '')",
    "long_bytes(n bigint) returns binary": "unhex(lpad(hex(n), 16, '0'))",
    "double_bytes(x double) returns binary": (
        "unhex(lpad(hex(cast(reflect('java.lang.Double', 'doubleToLongBits', x) as bigint)), 16, '0'))"
    ),
    # The accumulator of an average: made, merged, and read.
    "average_add(word string) returns struct<sum_len: bigint, n: bigint>": (
        "named_struct('sum_len', cast(length(word) as bigint), 'n', cast(if(word is null, 0, 1) as bigint))"
    ),
    "average_merge(a struct<sum_len: bigint, n: bigint>, b struct<sum_len: bigint, n: bigint>) "
    "returns struct<sum_len: bigint, n: bigint>": (
        "named_struct('sum_len', coalesce(a.sum_len, 0) + coalesce(b.sum_len, 0), "
        "'n', coalesce(a.n, 0) + coalesce(b.n, 0))"
    ),
    "average_finish(a struct<sum_len: bigint, n: bigint>) returns double": (
        "coalesce(try_divide(a.sum_len, a.n), double('NaN'))"
    ),
}
TABLES = {
    "words(line string) returns table(pos int, word string)": (
        "select at, w from posexplode(filter(split(line, '\\\\W+'), w -> w <> '')) as t(at, w)"
    ),
    "word_count(line string) returns table(word string, n bigint)": (
        "select w, count(*) from explode(split(line, '\\\\W+')) as t(w) where w <> '' group by w"
    ),
}

#: Jobs over a table of lines, by the name of the view that holds it.
JOBS = {
    "word_counts": "select word, count(*) as n from {lines}, lateral words(line) group by word",
    "windowed_word_counts": (
        "select win.start as window_start, win.end as window_end, word, count(*) as n "
        "from (select window(ts, '{size}') as win, line from {lines}), lateral words(line) group by all"
    ),
    "top_words": (
        "select * from (select *, row_number() over (partition by window_start order by n desc, word) as rank "
        "from ({windowed_word_counts})) where rank <= {k}"
    ),
    "longest_words": (
        "select max_by(word, struct(length(word), -id, -pos)) as word from {lines}, lateral words(line) "
        "having count(*) > 0"
    ),
    "average_word_lengths": (
        "select average_finish(named_struct('sum_len', sum(acc.sum_len), 'n', sum(acc.n))) as avg_len "
        "from (select average_add(word) as acc from {lines}, lateral words(line))"
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Makes the functions of ``SCALARS`` and ``TABLES`` known to the session; again is no harm."""
    for head, body in {**SCALARS, **TABLES}.items():
        spark.sql(f"create or replace temporary function {head} return {body}")


def register_jobs(spark: SparkSession, lines: str, size: str = "3 seconds", k: int = 3) -> None:
    """Temporary views with the results of the jobs over the view ``lines`` (``id, ts, line``)."""
    register_functions(spark)
    made: dict[str, str] = {}
    for name, text in JOBS.items():
        made[name] = text.format(lines=lines, size=size, k=k, **made)
        spark.sql(f"create or replace temporary view {name} as {made[name]}")
