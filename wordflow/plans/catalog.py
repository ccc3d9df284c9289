"""Queries over the test tables, each next to SQL that must give the same rows.

Every query reads whole tables. Those that need files or a stream's output write
them to a new folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wordflow.functions.mergeable import AVERAGE_LENGTH, LONGEST_WORD
from wordflow.operators.combine import combine_globally
from wordflow.operators.event_time import assign_event_time
from wordflow.operators.records import keyed_lines, to_records, value_lines, with_key
from wordflow.operators.stamps import judge_stamps, normalise_stamps, write_stamps
from wordflow.operators.tokens import words
from wordflow.operators.top import running_top_k
from wordflow.plans import words as jobs
from wordflow.session import SETTINGS, shared_folder
from wordflow.sinks.batches import batch_folders
from wordflow.sinks.outbox import DELIVERY, Outbox, append_to_table, arrived_in_table
from wordflow.sources.replay import fed_stream, paced_lines, staged_parts
from wordflow.sources.tables import spread
from wordflow.sources.text import placed_text_lines, text_lines, without_skipped
from wordflow.sql import register_jobs
from wordflow.streaming.elements import advance, running_words, timed_rows, timed_stream
from wordflow.streaming.panes import pane_stream
from wordflow.streaming.running import combine_so_far, running_stream
from wordflow.streaming.runs import run_available, run_in_turn, run_to_end
from wordflow.streaming.stamps import committed_lines, stamp_stream
from wordflow.streaming.top import top_k_so_far_stream
from wordflow.streaming.windows import count_stream, top_k_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BASE = datetime(2024, 1, 1)

# Settings of ``build_session`` that results or plans depend on.
NEEDED = (
    "spark.sql.session.timeZone",
    "spark.sql.files.minPartitionNum",
    "spark.sql.optimizer.windowGroupLimitThreshold",
)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def with_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Callers bring sessions of their own, which may lack what the operators expect.
            for key in NEEDED:
                spark.conf.set(key, SETTINGS[key])
            return run(spark, sf_dir)

        QUERIES[run.__name__] = with_settings
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


# Inputs


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return spread(documents.select("doc_id", F.col("text").alias("line")))


def _records(events: DataFrame, *kept: str) -> DataFrame:
    """Events as keyed records: errors have no key, views no value."""
    return events.select(
        "event_id",
        "ts",
        *kept,
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("key"),
        F.when(
            F.col("event_type") != "view", F.concat_ws(" ", "event_type", "props")
        ).alias("value"),
    )


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_records(spark.read.parquet(f"{sf_dir}/events.parquet")))


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_lines(_event_records(spark, sf_dir))


TEN_DAYS = 864_000


def _timed_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_lines(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def _span(at: Column) -> Column:
    """Spans of ten days. They are few: they go by the length of the time that the table covers."""
    return F.floor(F.unix_seconds(at) / TEN_DAYS)


def _in_turn(lines: DataFrame, folder: str, part: Column | None = None) -> list[str]:
    """``lines``, read once, in a folder per span of ten days or per value of ``part``, in this order."""
    return staged_parts(lines, f"{folder}/parts", _span(F.col("ts")) if part is None else part)


def _run_in_turn(
    spark: SparkSession,
    lines: DataFrame,
    folder: str,
    writer: Callable[[DataFrame], DataStreamWriter],
    part: Column | None = None,
) -> None:
    """A micro-batch per part of ``lines``, then the end of all windows."""
    parts = _in_turn(lines, folder, part)
    stream = fed_stream(spark, f"{folder}/in", lines.schema)
    run_to_end(stream, f"{folder}/ending", writer, parts=parts, feed=f"{folder}/in")


def _stamped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``date;rest`` lines, in a different shape per event type."""
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet"))
    kind = F.col("event_type")
    line = (
        F.when(kind == "click", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(";a;"), "props"))
        .when(kind == "purchase", F.concat(F.date_format("ts", "dd.MM.yyyy"), F.lit("; "), kind))
        .when(kind == "view", F.concat(F.lit(";"), "props"))
        .when(kind == "signup", F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" "), "props"))
        .otherwise(F.concat(F.lit("day "), F.date_format("ts", "dd"), F.lit(";"), "props"))
    )
    return events.select("event_id", line.alias("line"))


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


# The same inputs in SQL

DOCUMENT_WORDS = r"""
pieces as (select doc_id, list_filter(regexp_split_to_array(text, '\W+'), lambda w: w <> '') as a from documents),
words as (
    select doc_id, unnest(range(len(a))) as pos, unnest(a) as word from pieces
)"""

RECORDS = r"""
records as (
    select event_id, ts,
        case when event_type <> 'error' then user_id end as key,
        case when event_type <> 'view' then concat_ws(' ', event_type, props) end as value
    from events
),
lines as (
    select event_id, ts, coalesce(cast(key as varchar), '') || ' ' || coalesce(value, '') as line
    from records
)"""

EVENT_WORDS = RECORDS + r""",
pieces as (select event_id, ts, list_filter(regexp_split_to_array(line, '\W+'), lambda w: w <> '') as a from lines),
words as (
    select event_id, ts, unnest(range(len(a))) as pos, unnest(a) as word from pieces
)"""


def _windowed(size: str) -> str:
    return f"""
counts as (
    select time_bucket(interval '{size}', ts, timestamp '1970-01-01') as window_start,
        time_bucket(interval '{size}', ts, timestamp '1970-01-01') + interval '{size}' as window_end,
        word, count(*) as n
    from words group by all
)"""


def _windowed_sql(size: str) -> str:
    return f"with {EVENT_WORDS}, {_windowed(size)} select * from counts"


def _top(size: str, k: int) -> str:
    return f"""{EVENT_WORDS}, {_windowed(size)},
ranked as (
    select *, row_number() over (partition by window_start order by n desc, word) as rank
    from counts
),
top as (select * from ranked where rank <= {k})"""


def _top_sql(size: str, k: int) -> str:
    return f"with {_top(size, k)} select * from top"


RUNNING_AVERAGE = EVENT_WORDS + """,
running as (
    select event_id, pos, word as element,
        cast(sum(length(word)) over w as double) / count(*) over w as avg_len
    from words
    window w as (order by ts, event_id, pos rows unbounded preceding)
)"""

LONGEST_EVENT_WORD = "order by length(word) desc, ts, event_id, pos limit 1"


# Words and counts


@query(f"with {DOCUMENT_WORDS} select * from words")
def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(_document_lines(spark, sf_dir))


@query(
    r"""with pieces as (
        select conv_id, turn, role,
            list_filter(regexp_split_to_array(text, '\W+'), lambda w: w <> '') as a
        from conversations
    )
    select conv_id, turn, role, unnest(range(len(a))) as pos, unnest(a) as word from pieces"""
)
def conversation_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spread(spark.read.parquet(f"{sf_dir}/conversations.parquet")), line="text")


@query(f"with {DOCUMENT_WORDS} select word, count(*) as n from words group by word")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.word_count(_document_lines(spark, sf_dir))


@query(f"with {RECORDS} select event_id, ts, line from lines")
def keyed_record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_lines(spark, sf_dir)


@query(f"with {RECORDS} select event_id, ts, coalesce(value, '') as line from records")
def value_record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_lines(_event_records(spark, sf_dir))


@query(f"with {EVENT_WORDS} select word, count(*) as n from words group by word")
def keyed_line_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.word_count(_event_lines(spark, sf_dir))


@query(
    rf"""with {RECORDS},
    words as (
        select unnest(regexp_split_to_array(coalesce(value, ''), '\W+')) as word from records
    )
    select word, count(*) as n from words where word <> '' group by word"""
)
def value_line_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.word_count(value_lines(_event_records(spark, sf_dir)))


# Windows


@query(_windowed_sql("3 seconds"))
def windowed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.windowed_word_count(_event_lines(spark, sf_dir))


@query(_windowed_sql("7 seconds"))
def windowed_word_count_7s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.windowed_word_count(_event_lines(spark, sf_dir), "7 seconds")


@query(_windowed_sql("1 hour"))
def windowed_word_count_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.windowed_word_count(_event_lines(spark, sf_dir), "1 hour")


@query(_top_sql("1 day", 3))
def top_k_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_k_words(_event_lines(spark, sf_dir), "1 day", 3)


@query(_top_sql("10 seconds", 3))
def top_k_words_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_k_words(_event_lines(spark, sf_dir), "10 seconds", 3)


@query(_top_sql("240 hours", 1500))
def top_1500_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.top_k_words(_event_lines(spark, sf_dir), "240 hours", 1500)


@query(
    """select doc_id,
        row_number() over (order by doc_id) - 1 as place,
        timestamp '2024-01-01' + to_milliseconds(row_number() over (order by doc_id) - 1) as ts
    from documents"""
)
def assigned_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _document_lines(spark, sf_dir).select("doc_id")
    timed = assign_event_time(documents, ["doc_id"], BASE)
    place = F.unix_millis("ts") - F.unix_millis(F.lit(str(BASE)).cast("timestamp"))
    return _ntz(timed.withColumn("place", place), "ts")


@query(
    f"""with {DOCUMENT_WORDS},
    places as (select doc_id, row_number() over (order by doc_id) - 1 as i from documents),
    timed as (
        select word, timestamp '2024-01-01' + to_milliseconds(i) as ts
        from words join places using (doc_id)
    )
    select time_bucket(interval '3 seconds', ts, timestamp '1970-01-01') as window_start,
        time_bucket(interval '3 seconds', ts, timestamp '1970-01-01') + interval '3 seconds'
            as window_end,
        word, count(*) as n
    from timed group by all"""
)
def timed_document_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = assign_event_time(_document_lines(spark, sf_dir), ["doc_id"], BASE)
    return _ntz(jobs.windowed_word_count(timed), "window_start", "window_end")


# Global and running results


@query(f"with {DOCUMENT_WORDS} select word from words order by length(word) desc, doc_id, pos limit 1")
def longest_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.longest_word(_document_lines(spark, sf_dir), ["doc_id"])


AVERAGE = "round(cast(sum(length(word)) as double) / count(*), 6) as avg_len"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_len", F.round("avg_len", 6))


@query(f"with {DOCUMENT_WORDS} select {AVERAGE} from words")
def average_word_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(jobs.average_word_length(_document_lines(spark, sf_dir)))


def _wordless_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their word characters taken out, so that no word is found in them."""
    hidden = F.regexp_replace("line", r"\w+", "?")
    return _document_lines(spark, sf_dir).withColumn("line", hidden)


WORDLESS = r"""
hidden as (select regexp_replace(text, '\w+', '?', 'g') as text from documents),
words as (select unnest(list_filter(regexp_split_to_array(text, '\W+'), lambda w: w <> '')) as word from hidden)"""


@query(f"with {WORDLESS} select coalesce(avg(length(word)), cast('nan' as double)) as avg_len from words")
def average_empty_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.average_word_length(_wordless_lines(spark, sf_dir))


@query(f"with {WORDLESS} select avg(length(word)) as avg_len from words having count(*) > 0")
def average_empty_no_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.average_word_length(_wordless_lines(spark, sf_dir), with_default=False)


@query(
    """select lpad(cast(event_id as varchar), 12, '0') as word from events
    order by case when event_type <> 'error' then ts end nulls first, event_id limit 1"""
)
def longest_word_null_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equally long words the earliest, where errors have no time and so come first."""
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet"))
    known = F.when(F.col("event_type") != "error", F.col("ts"))
    word = F.lpad(F.col("event_id").cast("string"), 12, "0")
    rows = events.select("event_id", word.alias("word"), known.alias("known"))
    return combine_globally(rows, LONGEST_WORD, order=["known", "event_id"], with_default=False)


@query(
    f"""with {RUNNING_AVERAGE}
    select event_id, pos, element, round(avg_len, 6) as avg_len from running"""
)
def running_average_word_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = jobs.running_average_word_length(_event_lines(spark, sf_dir), ["ts", "event_id"])
    return _rounded(running.select("event_id", "pos", "element", "avg_len"))


@query(
    f"""with {EVENT_WORDS},
    numbered as (
        select event_id, pos, word as element,
            row_number() over (order by ts, event_id, pos) as i
        from words
    ),
    running as (
        select event_id, pos, element, i,
            (max({{'n': length(element), 'j': -i, 'w': element}})
                over (order by i rows unbounded preceding)).w as word
        from numbered
    )
    select event_id, pos, element, word, false as is_final from running
    union all
    (select null, null, null, word, true from running order by i desc limit 1)"""
)
def running_longest_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = jobs.running_longest_word(_event_lines(spark, sf_dir), ["ts", "event_id"])
    return running.select("event_id", "pos", "element", "word", "is_final")


# Records


def _shown(records: DataFrame, *kept: str) -> DataFrame:
    return records.select(*kept, F.hex("key").alias("key"), F.hex("value").alias("value"))


@query(
    f"""with {_top("1 day", 3)}
    select hex(encode(word)) as key, hex(n::bigint::bit::blob) as value from top"""
)
def records_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = jobs.top_k_words(_event_lines(spark, sf_dir), "1 day", 3)
    return _shown(to_records(top, key="word", value="n"))


@query(
    f"""with {EVENT_WORDS}
    select '' as key, hex(encode(word)) as value from words {LONGEST_EVENT_WORD}"""
)
def records_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    longest = jobs.longest_word(_event_lines(spark, sf_dir), ["ts", "event_id"])
    return _shown(to_records(with_key(longest), value="word"))


@query(
    f"""with {RUNNING_AVERAGE}
    select '' as key, hex(avg_len::bit::blob) as value from running"""
)
def records_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = jobs.running_average_word_length(_event_lines(spark, sf_dir), ["ts", "event_id"])
    return _shown(to_records(with_key(running.select("avg_len")), value="avg_len"))


# Stamps

STAMPED = """
stamped as (
    select event_id, case event_type
        when 'click' then strftime(ts, '%Y-%m-%d %H:%M:%S') || ';a;' || props
        when 'purchase' then strftime(ts, '%d.%m.%Y') || '; ' || event_type
        when 'view' then ';' || props
        when 'signup' then strftime(ts, '%Y-%m-%d') || ' ' || props
        else 'day ' || strftime(ts, '%d') || ';' || props end as line
    from events
),
cut as (
    select *, strpos(line, ';') as at,
        case when strpos(line, ';') > 0 then substr(line, 1, strpos(line, ';') - 1) end as date,
        case when strpos(line, ';') > 0 then substr(line, strpos(line, ';') + 1) end as rest
    from stamped
),
judged as (
    select *, coalesce(date, '') <> '' and coalesce(rest, '') <> '' as complete,
        try_strptime(date, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%Y/%m/%d %H:%M:%S', '%d.%m.%Y']) as t
    from cut
)"""


@query(
    f"""with {STAMPED}
    select event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || '+00:00' as stamp, rest
    from judged where complete and t is not null"""
)
def stamps_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_stamps(_stamped_lines(spark, sf_dir))[0]


@query(
    f"""with {STAMPED}
    select event_id, line,
        case when complete then 'unparsable_date' else 'missing_semicolon' end as reason
    from judged where not complete or t is null"""
)
def stamps_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_stamps(_stamped_lines(spark, sf_dir))[1]


@query(
    f"""with {STAMPED}
    select event_id,
        case when complete and t is not null then 'accepted' when complete then 'unparsable_date'
            else 'missing_semicolon' end as outcome,
        case when complete and t is not null
            then strftime(t, '%Y-%m-%dT%H:%M:%S') || '+00:00;' || rest else line end as line
    from judged"""
)
def stamps_written_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned lines and rejects from one pass over the lines, a folder per outcome."""
    folder = shared_folder(spark, "stamps")
    write_stamps(judge_stamps(_stamped_lines(spark, sf_dir)), folder)
    return spark.read.parquet(folder).select("event_id", "outcome", "line")


# Text files

TEXT_LINES = r"""
lines as (
    select unnest(regexp_split_to_array(text, '\r\n|\r|\n')) as line from documents
)"""


def _text_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark, "text")
    _document_lines(spark, sf_dir).select("line").write.text(folder)
    return folder


@query(
    rf"""with {TEXT_LINES},
    words as (select unnest(regexp_split_to_array(line, '\W+')) as word from lines)
    select word, count(*) as n from words where word <> '' group by word"""
)
def text_file_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.word_count(text_lines(spark, _text_folder(spark, sf_dir)))


@query(f"with {TEXT_LINES} select line, count(*) as n from lines where line not in (' *', '') group by line")
def replayed_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_skipped(text_lines(spark, _text_folder(spark, sf_dir)))
    return kept.groupBy("line").agg(F.count("*").alias("n"))


@query(
    f"""with {TEXT_LINES}
    select count(*) as lines, count(*) as places, 0 as first, count(*) - 1 as last,
        sum(length(line)) as chars from lines"""
)
def text_line_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text files are numbered through without gaps."""
    placed = placed_text_lines(spark, _text_folder(spark, sf_dir))
    return placed.agg(
        F.count("*").alias("lines"),
        F.count_distinct("place").alias("places"),
        F.min("place").alias("first"),
        F.max("place").alias("last"),
        F.sum(F.length("line")).alias("chars"),
    )


# Streams


@query(f"with {TEXT_LINES} select line, count(*) as n from lines where line not in (' *', '') group by line")
def stream_replayed_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "paced")
    one_file_per_core = spark.sparkContext.defaultParallelism
    paced = paced_lines(spark, _text_folder(spark, sf_dir), one_file_per_core)
    writer = (
        paced.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state")
    )
    run_available(spark, writer)
    return spark.read.parquet(f"{folder}/out").groupBy("line").agg(F.count("*").alias("n"))


@query(_windowed_sql("1 hour"))
def stream_windowed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "windows")
    _run_in_turn(
        spark,
        _timed_event_lines(spark, sf_dir),
        folder,
        lambda lines: count_stream(lines, "1 hour", f"{folder}/out", f"{folder}/state"),
    )
    return _ntz(spark.read.parquet(f"{folder}/out"), "window_start", "window_end")


# Views come five hours late, errors two days.
DELAYED_WORDS = f"""{RECORDS},
arrivals as (
    select l.event_id, l.ts, l.line, floor(epoch(l.ts + case e.event_type
        when 'view' then interval '5 hours' when 'error' then interval '2 days'
        else interval '0 hours' end) / {TEN_DAYS}) as span
    from lines l join events e using (event_id)
),
marks as (
    select span, max(max(ts)) over (order by span rows between unbounded preceding and 1 preceding)
        - interval '6 hours' as mark
    from arrivals group by span
),
on_time as (
    select a.* from arrivals a join marks m using (span)
    where mark is null
        or time_bucket(interval '1 hour', ts, timestamp '1970-01-01') + interval '1 hour' > mark
),
pieces as (select event_id, ts, list_filter(regexp_split_to_array(line, '\\W+'), lambda w: w <> '') as a from on_time),
words as (
    select event_id, ts, unnest(range(len(a))) as pos, unnest(a) as word from pieces
)"""


def _arrival() -> Column:
    """When a row comes: views are five hours late, errors two days."""
    seconds = "case event_type when 'view' then 18000 when 'error' then 172800 else 0 end"
    return F.expr(f"ts + make_interval(0, 0, 0, 0, 0, 0, {seconds})")


def _delayed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _records(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_type")
    return keyed_lines(events).withColumn("ts", F.col("ts").cast("timestamp"))


@query(f"with {DELAYED_WORDS}, {_windowed('1 hour')} select * from counts")
def stream_windowed_word_count_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows up to six hours late count. Five hours late ones do, some of those two days late don't."""
    folder = shared_folder(spark, "late")
    lines = _delayed_lines(spark, sf_dir)
    _run_in_turn(
        spark,
        lines,
        folder,
        lambda stream: count_stream(
            stream, "1 hour", f"{folder}/out", f"{folder}/state", lateness="6 hours"
        ),
        part=_span(_arrival()),
    )
    return _ntz(spark.read.parquet(f"{folder}/out"), "window_start", "window_end")


@query(
    f"""with {EVENT_WORDS}, {_windowed("1 hour")}
    select * from counts where window_start >= timestamp '2024-01-16'"""
)
def stream_late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the events comes first, so the earlier half is late."""
    folder = shared_folder(spark, "halves")
    lines = _timed_event_lines(spark, sf_dir)
    later = F.col("ts") >= "2024-01-16"
    _run_in_turn(
        spark,
        lines,
        folder,
        lambda stream: count_stream(stream, "1 hour", f"{folder}/out", f"{folder}/state"),
        part=F.when(later, 0).otherwise(1),
    )
    return _ntz(spark.read.parquet(f"{folder}/out"), "window_start", "window_end")


@query(_top_sql("1 day", 3))
def stream_top_k_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "top")
    _run_in_turn(
        spark,
        _timed_event_lines(spark, sf_dir),
        folder,
        lambda lines: top_k_stream(
            lines, "1 day", 3, batch_folders(f"{folder}/out"), f"{folder}/state"
        ),
    )
    top = spark.read.parquet(f"{folder}/out").drop("batch_id")
    return _ntz(top, "window_start", "window_end")


def _results_in_turn(
    spark: SparkSession,
    lines: DataFrame,
    folder: str,
    results: Callable[[DataFrame], DataFrame],
    part: Column | None = None,
) -> DataFrame:
    """What ``results`` gives after each part, with ``batch_id``."""
    parts = _in_turn(lines, folder, part)
    stream = fed_stream(spark, f"{folder}/in", lines.schema)
    writer = running_stream(results(stream), batch_folders(f"{folder}/out"), f"{folder}/state")
    run_in_turn(spark, writer, parts, f"{folder}/in")
    return spark.read.parquet(f"{folder}/out")


def _longest_so_far(lines: DataFrame) -> DataFrame:
    found = words(lines.withWatermark("ts", "0 seconds"))
    return combine_so_far(found, LONGEST_WORD, order=["ts", "event_id", "pos"], repeat_last=True)


def _average_so_far(lines: DataFrame) -> DataFrame:
    return combine_so_far(words(lines, pos=None), AVERAGE_LENGTH)


@query(f"with {EVENT_WORDS} select word from words {LONGEST_EVENT_WORD}")
def stream_longest_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _timed_event_lines(spark, sf_dir)
    results = _results_in_turn(spark, lines, shared_folder(spark, "longest"), _longest_so_far)
    return results.agg(F.max_by("word", "batch_id").alias("word"))


@query(f"with {EVENT_WORDS} select {AVERAGE} from words")
def stream_average_word_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _timed_event_lines(spark, sf_dir)
    results = _results_in_turn(spark, lines, shared_folder(spark, "average"), _average_so_far)
    return _rounded(results.agg(F.max_by("avg_len", "batch_id").alias("avg_len")))


def _wordless_first(lines: DataFrame) -> DataFrame:
    """``lines``, and as an earlier ``half`` all of them without their words."""
    hidden = F.struct(F.lit(0).alias("half"), F.regexp_replace("line", r"\w+", "?").alias("line"))
    shown = F.struct(F.lit(1).alias("half"), F.col("line"))
    halves = lines.select("*", F.explode(F.array(hidden, shown)).alias("two"))
    return halves.select(*[c for c in lines.columns if c != "line"], "two.*")


def _half_spans() -> Column:
    """The lines of a span come after its lines without words."""
    return 2 * _span(F.col("ts")) + F.col("half")


SPANS = f"""{EVENT_WORDS},
spans as (select *, floor(epoch(ts) / {TEN_DAYS}) as span from words)"""


@query(
    f"""with {SPANS}
    select row_number() over (order by span) as result, round(avg_len, 6) as avg_len from (
        select span, sum(sum(length(word))) over (order by span) / sum(count(*)) over (order by span) as avg_len
        from spans group by span
    )"""
)
def stream_average_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results, in order. A micro-batch of lines without words gives none."""
    lines = _wordless_first(_timed_event_lines(spark, sf_dir))
    results = _results_in_turn(spark, lines, shared_folder(spark, "averages"), _average_so_far, _half_spans())
    # As many rows as micro-batches.
    place = F.row_number().over(Window.orderBy("batch_id")).cast("bigint")
    return _rounded(results.select(place.alias("result"), "avg_len"))


@query(
    f"""with {SPANS},
    best as (
        select span, max({{'n': length(word), 'j': -epoch_us(ts), 'e': -event_id, 'p': -pos, 'w': word}}) as b
        from spans group by span
    ),
    so_far as (select span, (max(b) over (order by span)).w as word from best),
    results as (
        select 3 * row_number() over (order by span) - which as place,
            case when which > 0 then lag(word) over (partition by which order by span) else word end as word
        from so_far, (select unnest([2, 1, 0]) as which)
    )
    select row_number() over (order by place) as result, word from results where word is not null"""
)
def stream_longest_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results, in order; none, and no null, while there was no word yet.

    Lines without words move the watermark, and the last result comes once more
    with them and once when the watermark moves on.
    """
    lines = _wordless_first(_timed_event_lines(spark, sf_dir))
    results = _results_in_turn(spark, lines, shared_folder(spark, "longests"), _longest_so_far, _half_spans())
    # As many rows as micro-batches.
    place = F.row_number().over(Window.orderBy("batch_id")).cast("bigint")
    return results.select(place.alias("result"), "word")


# Results per element, event times and panes of streams


@query(
    f"""with {RUNNING_AVERAGE}
    select event_id, pos, element, round(avg_len, 6) as avg_len from running"""
)
def stream_running_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The average after every word of the stream, over all micro-batches so far."""
    folder = shared_folder(spark, "elements")
    _run_in_turn(
        spark,
        _timed_event_lines(spark, sf_dir),
        folder,
        lambda lines: running_words(
            lines, AVERAGE_LENGTH, ["ts", "event_id"], batch_folders(f"{folder}/out"),
            f"{folder}/totals", f"{folder}/state", with_default=True,
        ),
    )
    running = spark.read.parquet(f"{folder}/out").filter("not is_final")
    return _rounded(running.select("event_id", "pos", "element", "avg_len"))


@query(ORACLES["running_longest_word"])
def stream_running_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest word after every word of the stream, and once more at the end."""
    folder = shared_folder(spark, "elements")
    _run_in_turn(
        spark,
        _timed_event_lines(spark, sf_dir),
        folder,
        lambda lines: running_words(
            lines, LONGEST_WORD, ["ts", "event_id"], batch_folders(f"{folder}/out"),
            f"{folder}/totals", f"{folder}/state", with_final=True,
        ),
    )
    return spark.read.parquet(f"{folder}/out").select("event_id", "pos", "element", "word", "is_final")


@query(f"with {WORDLESS} select coalesce(avg(length(word)), cast('nan' as double)) as avg_len from words")
def stream_average_empty_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of lines without words: its end gives the default, once."""
    folder = shared_folder(spark, "wordless")
    hidden = F.regexp_replace("line", r"\w+", "?")
    lines = _timed_event_lines(spark, sf_dir).withColumn("line", hidden)
    _run_in_turn(
        spark,
        lines,
        folder,
        lambda stream: running_words(
            stream, AVERAGE_LENGTH, ["ts", "event_id"], batch_folders(f"{folder}/out"),
            f"{folder}/totals", f"{folder}/state", with_default=True,
        ),
    )
    return spark.read.parquet(f"{folder}/out").select("avg_len")


def _document_parts(documents: DataFrame, folder: str) -> list[str]:
    """Four parts in the order of the ids."""
    last = documents.agg(F.max("doc_id")).first()[0]
    return _in_turn(documents, folder, F.floor(4 * F.col("doc_id") / (last + 1)))


def _with_places(timed: DataFrame) -> DataFrame:
    place = F.unix_millis("ts") - F.unix_millis(F.lit(str(BASE)).cast("timestamp"))
    return _ntz(timed.select("doc_id", place.alias("place"), "ts"), "ts")


@query(ORACLES["assigned_event_times"])
def stream_assigned_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a stream get the times that the whole table would give them."""
    folder = shared_folder(spark, "times")
    documents = _document_lines(spark, sf_dir).select("doc_id")
    parts = _document_parts(documents, folder)
    stream = fed_stream(spark, f"{folder}/in", documents.schema)
    writer = timed_stream(
        stream, ["doc_id"], BASE, batch_folders(f"{folder}/out"), f"{folder}/totals", f"{folder}/state"
    )
    run_in_turn(spark, writer, parts, f"{folder}/in")
    return _with_places(spark.read.parquet(f"{folder}/out"))


# Tables that grow


@query(ORACLES["stream_running_average"])
def growing_running_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that grows by ten days at a time: each batch reads its own rows and a row of totals."""
    folder = shared_folder(spark, "growing")
    write = batch_folders(f"{folder}/out")
    for number, part in enumerate(_in_turn(_timed_event_lines(spark, sf_dir), folder)):
        running, _ = advance(
            spark.read.parquet(part), number, f"{folder}/totals", AVERAGE_LENGTH, ["ts", "event_id"],
            element="element", expand=lambda rows: words(rows, "line", "element"), within=["pos"],
        )
        write(running, number)
    return _rounded(spark.read.parquet(f"{folder}/out").select("event_id", "pos", "element", "avg_len"))


@query(ORACLES["assigned_event_times"])
def growing_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times of a table of documents that comes in four batches."""
    folder = shared_folder(spark, "growing-times")
    write = batch_folders(f"{folder}/out")
    for number, part in enumerate(_document_parts(_document_lines(spark, sf_dir).select("doc_id"), folder)):
        write(timed_rows(spark.read.parquet(part), number, f"{folder}/totals", ["doc_id"], BASE), number)
    return _with_places(spark.read.parquet(f"{folder}/out"))


PANES = f"""{RECORDS},
arrivals as (
    select l.event_id, l.ts, l.line, floor(epoch(l.ts + case e.event_type
        when 'view' then interval '5 hours' when 'error' then interval '2 days'
        else interval '0 hours' end) / {TEN_DAYS}) as span
    from lines l join events e using (event_id)
),
marks as (
    select span, max(max(ts)) over (order by span rows between unbounded preceding and 1 preceding) as before,
        max(max(ts)) over (order by span) as upto
    from arrivals group by span
),
placed as (
    select a.*, before, time_bucket(interval '1 hour', ts, timestamp '1970-01-01') + interval '1 hour' as window_end
    from arrivals a join marks using (span)
),
kept as (
    select *, coalesce(window_end <= before, false) as late from placed
    where before is null or window_end > before - interval '6 hours'
),
words as (
    select span, window_end, late,
        unnest(list_filter(regexp_split_to_array(line, '\\W+'), lambda w: w <> '')) as word
    from kept
),
closed as (
    select window_end, min(upto) as reached
    from (select distinct window_end from kept) left join marks on upto >= window_end group by window_end
),
first_panes as (
    select window_end, word, 0 as pane, 'on_time' as timing,
        coalesce(reached - interval '6 hours' >= window_end, true) as is_last, count(*) as n
    from words join closed using (window_end) where not late group by window_end, word, reached
),
late_panes as (
    select l.window_end, l.word, row_number() over (partition by l.window_end, l.word order by span) - 1
            + (f.word is not null)::int as pane, 'late' as timing, false as is_last, l.n
    from (select window_end, word, span, count(*) as n from words where late group by all) l
    left join first_panes f on f.window_end = l.window_end and f.word = l.word
)"""


@query(
    f"""with {PANES}
    select window_end - interval '1 hour' as window_start, window_end, word, cast(pane as integer) as pane,
        timing, is_last, n
    from (select * from first_panes union all select * from late_panes)"""
)
def stream_window_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows fire when they close and again for rows up to six hours late, which are counted alone."""
    folder = shared_folder(spark, "panes")
    _run_in_turn(
        spark,
        _delayed_lines(spark, sf_dir),
        folder,
        lambda stream: pane_stream(stream, "1 hour", f"{folder}/out", f"{folder}/state", lateness="6 hours"),
        part=_span(_arrival()),
    )
    return _ntz(spark.read.parquet(f"{folder}/out"), "window_start", "window_end")


# The top k of all windows so far

RUNNING_TOP = f"""{EVENT_WORDS}, {_windowed("1 day")},
days as (select distinct window_start, window_end from counts),
so_far as (
    select d.window_start, d.window_end, c.word, c.n, c.window_start as found_at,
        row_number() over (partition by d.window_start order by c.n desc, c.word, c.window_start) as rank
    from days d join counts c on c.window_start <= d.window_start
)"""


@query(f"with {RUNNING_TOP} select * replace (cast(rank as integer) as rank) from so_far where rank <= 5")
def running_top_k_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = jobs.windowed_word_count(_event_lines(spark, sf_dir), "1 day")
    return running_top_k(counts, 5)


@query(f"with {RUNNING_TOP} select * replace (cast(rank as integer) as rank) from so_far where rank <= 5")
def stream_top_k_so_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream, of which a state of five entries is kept."""
    folder = shared_folder(spark, "top-so-far")
    _run_in_turn(
        spark,
        _timed_event_lines(spark, sf_dir),
        folder,
        lambda lines: top_k_so_far_stream(
            lines, "1 day", 5, batch_folders(f"{folder}/out"), f"{folder}/entries", f"{folder}/state"
        ),
    )
    top = spark.read.parquet(f"{folder}/out").drop("batch_id")
    return _ntz(top, "window_start", "window_end", "found_at")


# Delivery and clean-up of streams, each record once


class _Killed(Exception):
    """Stands for the loss of the driver."""


@query(ORACLES["records_long"])
def stream_top_k_delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records at a target that keeps what it gets. The job dies amid a send, then between a send and its commit."""
    folder, deaths, died = shared_folder(spark, "delivery"), ["amid", "behind"], []
    deliver = append_to_table(f"{folder}/topic")

    def send(records: DataFrame) -> None:
        encoded = to_records(records, "word", "n", DELIVERY)
        death = deaths.pop(0) if deaths and not records.isEmpty() else None
        deliver(encoded.filter(F.crc32("key") % 2 == 0) if death == "amid" else encoded)
        if death:
            died.append(death)
            raise _Killed(death)

    def arrived(records: DataFrame) -> DataFrame:
        return arrived_in_table(f"{folder}/topic")(to_records(records, "word", "n", DELIVERY))

    key = ["window_start", "word"]
    lines = _timed_event_lines(spark, sf_dir)
    parts = _in_turn(lines, folder)
    for life in range(len(deaths) + 1):
        outbox = Outbox(spark, "top words", f"{folder}/sent", key, send, arrived)
        try:
            run_to_end(
                fed_stream(spark, f"{folder}/in", lines.schema),
                f"{folder}/ending",
                lambda stream: top_k_stream(stream, "1 day", 3, outbox, f"{folder}/state"),
                parts=parts,
                feed=f"{folder}/in",
            )
            break
        except StreamingQueryException:
            if len(died) <= life:
                raise
    return _shown(spark.read.parquet(f"{folder}/topic"))


@query(ORACLES["stamps_written_once"])
def stream_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned lines and rejects of a stream, from one read and with one commit per micro-batch."""
    folder = shared_folder(spark, "stamp-stream")
    lines = _stamped_lines(spark, sf_dir)
    last = lines.agg(F.max("event_id")).first()[0]
    parts = _in_turn(lines, folder, F.floor(4 * F.col("event_id") / (last + 1)))
    stream = fed_stream(spark, f"{folder}/in", lines.schema)
    run_in_turn(spark, stamp_stream(stream, f"{folder}/out", f"{folder}/state"), parts, f"{folder}/in")
    found = committed_lines(spark, f"{folder}/out", lines.schema)
    return found.select("event_id", "outcome", "line")


# The jobs from SQL


def _sql_jobs(lines: DataFrame, size: str = "3 seconds") -> SparkSession:
    lines.createOrReplaceTempView("wordflow_lines")
    register_jobs(lines.sparkSession, "wordflow_lines", size=size)
    return lines.sparkSession


def _sql_documents(spark: SparkSession, sf_dir: str) -> SparkSession:
    timed = _document_lines(spark, sf_dir).withColumn("ts", F.lit(str(BASE)).cast("timestamp"))
    return _sql_jobs(timed.withColumnRenamed("doc_id", "id"))


@query(ORACLES["word_count"])
def sql_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql_documents(spark, sf_dir).sql("select * from word_counts")


@query(ORACLES["longest_word"])
def sql_longest_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql_documents(spark, sf_dir).sql("select * from longest_words")


@query(ORACLES["average_word_length"])
def sql_average_word_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_sql_documents(spark, sf_dir).sql("select * from average_word_lengths"))


@query(_top_sql("1 day", 3))
def sql_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _event_lines(spark, sf_dir).withColumnRenamed("event_id", "id")
    return _sql_jobs(lines, "1 day").sql("select * from top_words")
