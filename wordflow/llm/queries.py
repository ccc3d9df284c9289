"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordflow.llm.alignment import align_tokenizers
from wordflow.llm.common import written
from wordflow.llm.decontamination import contaminated
from wordflow.llm.line_dedup import line_dedup
from wordflow.llm.lm import lm_scores
from wordflow.llm.mixing import mix_sources
from wordflow.llm.pieces import sentencepiece_encode
from wordflow.llm.quality import quality_rules
from wordflow.llm.repeats import remove_repeats
from wordflow.llm.runs import periodic_runs
from wordflow.llm.simhash import simhash_groups
from wordflow.llm.token_counts import (
    Rollup,
    copies_marked,
    count_documents,
    deletes,
    inserts,
    revisions,
)
from wordflow.llm.toxicity import fit_toxicity, held_out, labelled_sample, toxicity_scores
from wordflow.llm.warc import warc_round_trip
from wordflow.session import shared_folder, ship_package
from wordflow.sources.tables import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = shipped
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

@query(
    r"""
with pages_ as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
quints as (
    select page_id, html, h, string_agg(
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31) + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1), '' order by i) as digest
    from (select *, unnest(range(8)) as i from pages_),
        lateral (select cast('0x' || substr(h, 5 * i + 1, 5) as integer) as v)
    group by page_id, html, h
),
firsts as (select html, max(page_id) as largest from pages_ group by html)
select page_id, strlen(q.html) as payload_bytes, digest as payload_digest,
    case when page_id = largest then 'response' else 'revisit' end as record_type,
    case when page_id <> largest then largest end as refers_to
from quints q join firsts f on q.html = f.html
"""
)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its record, read back from normalised archives."""
    pages = table(spark, sf_dir, "pages")
    return warc_round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUALITY_SQL = r"""
with texts as (select doc_id, lang, source, coalesce(text, '') as text from documents),
words as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from texts
),
runs as (
    select doc_id, i, array_to_string(list_slice(w, i + 1, i + 8), ' ') as run
    from (select doc_id, w, unnest(range(len(w) - 7)) as i from words where len(w) >= 8)
),
twice as (
    select doc_id, i from runs
    qualify count(*) over (partition by doc_id, run) >= 2
),
covered as (
    select doc_id, count(*) as n from (
        select distinct doc_id, unnest(range(i, i + 8)) as pos from twice
    ) group by doc_id
),
counts as (
    select doc_id, lang, source, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
        len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
        len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
        coalesce(n, 0) as n_repeat_words
    from words left join covered using (doc_id)
),
measured as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
        coalesce(100 * word_chars // nullif(n_words, 0), 0) as word_length,
        coalesce(1000 * n_symbols // nullif(n_words, 0), 0) as symbol_rate,
        coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) as dup_line_rate
    from counts
),
long as (
    select lang, source, unnest(['word_length', 'symbol_rate', 'dup_line_rate']) as measure,
        unnest([word_length, symbol_rate, dup_line_rate]) as v
    from measured
),
sketch as (
    select lang, source, measure, (v >> spare) << spare as bucket, count(*) as n
    from (select *, greatest(length(bin(v)) - 6, 0) as spare from long) group by all
),
of_lang as (select lang, measure, bucket, sum(n) as l from sketch group by all),
of_all as (select measure, bucket, sum(l) as a from of_lang group by all),
in_lang as (select lang, measure, sum(l) as in_lang from of_lang group by all),
in_all as (select measure, sum(a) as in_all from of_all group by all),
groups as (select distinct lang, source, measure from sketch),
known as (
    select g.*, in_lang::hugeint as in_lang, in_all::hugeint as in_all
    from groups g join in_lang i on g.measure = i.measure and g.lang is not distinct from i.lang
    join in_all e on g.measure = e.measure
),
parts as (
    select k.lang, k.source, k.measure, s.bucket, s.n * in_all * (in_lang + 50) as n
    from known k join sketch s on k.measure = s.measure
        and k.lang is not distinct from s.lang and k.source is not distinct from s.source
    union all
    select k.lang, k.source, k.measure, o.bucket, 50 * o.l * in_all
    from known k join of_lang o on k.measure = o.measure and k.lang is not distinct from o.lang
    union all
    select k.lang, k.source, k.measure, o.bucket, 50 * 50 * o.a from known k join of_all o on k.measure = o.measure
),
merged as (select lang, source, measure, bucket, sum(n) as n from parts group by all),
ranked as (
    select *, sum(n) over (partition by lang, source, measure order by bucket) as below,
        sum(n) over (partition by lang, source, measure) as size
    from merged
),
quartiles as (
    select lang, source, measure,
        min(bucket) filter (4 * below >= size) as q1, min(bucket) filter (4 * below >= 3 * size) as q3,
        q3 + (cast(1 as bigint) << greatest(length(bin(q3)) - 6, 0)) - 1 as top
    from ranked group by all
),
limits as (
    select lang, source,
        max(q1 - greatest(3 * (q3 - q1), 200)) filter (measure = 'word_length') as length_low,
        max(top + greatest(3 * (q3 - q1), 200)) filter (measure = 'word_length') as length_high,
        max(top + greatest(3 * (q3 - q1), 50)) filter (measure = 'symbol_rate') as symbol_high,
        max(top + greatest(3 * (q3 - q1), 500)) filter (measure = 'dup_line_rate') as dup_high
    from quartiles group by all
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and word_length between l.length_low and l.length_high
        and symbol_rate <= l.symbol_high and dup_line_rate <= l.dup_high as kept
from measured m join limits l
    on m.lang is not distinct from l.lang and m.source is not distinct from l.source
"""


@query(QUALITY_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the counts of the base rule and both verdicts."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, carry=docs.select("doc_id"))


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its fingerprint and the smallest document of its group."""
    return simhash_groups(table(spark, sf_dir, "documents"), carry=False)


@query(
    r"""
with lines as (
    select doc_id, unnest(range(len(a))) as pos, unnest(a) as line
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as a from documents)
),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
),
shared as (
    select key, min(doc_id) as first from keyed where length(key) >= 10
    group by key having count(distinct doc_id) >= 2
),
judged as (
    select k.doc_id, k.pos, k.line, coalesce(k.doc_id <> s.first, false) as gone
    from keyed k left join shared s on k.key = s.key and length(k.key) >= 10
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""
)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, dropped lines, digest of what is left."""
    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: digests of its ids and of the text that they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sentencepiece_encode(docs, PIECE_MODEL, back=True)
    ids = F.array_join(F.col("pieces.ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("pieces.ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("pieces.decoded", 256).alias("decoded_sha256"),
    )


@query()
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: what is removed as repeated strings, and a digest of what is left."""
    docs = table(spark, sf_dir, "documents")
    return remove_repeats(docs, carry=docs.select("doc_id")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document and benchmark item that it leaks: how much of it, and where."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of two tokenizer versions after six commits, of which one is made again, and two foldings.

    Guesses come first, then the counts in their place, and later copies go. Then all
    documents that are left are counted under the new version, and those that are not
    English leave the old one.
    """
    docs, pattern = table(spark, sf_dir, "documents"), public_tokenizers.PATTERN
    old = written(copies_marked(count_documents(docs, "byte_bpe_50k", BYTE_RANKS, pattern)), "old")
    new = copies_marked(count_documents(docs, "byte_bpe_multi_50k", MULTI_RANKS, pattern)).filter("not later")
    rollup = Rollup(spark, shared_folder(spark, "rollup"))
    rollup.commit("guesses", inserts(old, "guess"))
    rollup.commit("counts", revisions(old, "guess", "tokens"))
    rollup.commit("copies", deletes(old.filter("later")))
    rollup.commit("counts", revisions(old, "guess", "tokens"))
    rollup.compact()
    rollup.commit("new-version", inserts(new))
    rollup.commit("moved", deletes(old.filter("not later and not lang <=> 'en'")))
    rollup.commit("copies", deletes(old.filter("later")))
    rollup.compact()
    return rollup.totals()


@query()
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words and their summed and mean log-probability."""
    docs = table(spark, sf_dir, "documents")
    return lm_scores(docs, carry=docs.select("doc_id"))


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its score, learned from the labels of rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    model = fit_toxicity(labelled_sample(docs, labels))
    scored = toxicity_scores(docs, model, carry=docs.select("doc_id"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_clauses")


@query(
    r"""
with measured as (
    select doc_id, source, coalesce(text, '') as text,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
    from documents
),
ticketed as (
    select doc_id, source, size, length(bin(size)) as preference,
        cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || text), 1, 13) as bigint)
            as ticket
    from measured
),
sizes as (
    select source, cast(sum(size) as double) as s, 3 * cast(sum(size) as double) as cap,
        [5.0::double, 2, 1][((row_number() over (order by source nulls last) - 1) % 3) + 1] as weight
    from ticketed group by source
),
judged as (
    select *, sum(s) over () as total,
        cap * sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following)
            <= (sum(s) over () - coalesce(sum(cap) over (order by cap / weight, source nulls last
                rows between unbounded preceding and 1 preceding), 0)) * weight as stops
    from sizes
),
targets as (
    select source, s as source_size, case when stops then cap
        else (total - sum(case when stops then cap else 0 end) over ())
            / sum(case when stops then 0 else weight end) over () * weight end as target
    from judged
),
classes as (
    select source, preference, cast(sum(size) as double) as words from ticketed group by source, preference
),
ordered as (
    select c.*, source_size, target,
        (target - 3 * coalesce(sum(words) over (partition by c.source order by preference desc
            rows between unbounded preceding and 1 preceding), 0)) * preference
        >= 3 * sum(words * preference) over (partition by c.source order by preference desc
            rows between current row and unbounded following) as full_
    from classes c join targets t on c.source is not distinct from t.source
),
rated as (
    select *, case when full_ then 3.0::double else least(3.0::double, coalesce(
        (target - 3 * sum(case when full_ then words else 0 end) over (partition by source))
        / nullif(sum(case when full_ then 0 else words * preference end) over (partition by source), 0), 0)
        * preference) end as copies
    from ordered
),
planned as (
    select *, floor(copies) as whole, copies - floor(copies) as chance,
        target - sum(floor(copies) * words) over (partition by source) as left_
    from rated
),
drawn as (
    select d.doc_id, d.size, p.source, p.source_size, p.target, p.whole, p.chance, p.left_,
        ((d.ticket + 0.5) / 4503599627370496.0::double) as u, d.ticket
    from ticketed d join planned p on d.source is not distinct from p.source and d.preference = p.preference
),
ranked as (
    select *, case when chance > 0 and size > 0 then u / (1 - u) / (chance / (1 - chance)) end as odds from drawn
),
ordered_docs as (
    select *, sum(size) over (partition by source, odds is null
        order by floor(odds / (1 + odds) * 9007199254740992.0::double), doc_id rows unbounded preceding) as upto
    from ranked
)
select doc_id, size, cast(source_size as bigint) as source_size, target,
    cast(size * (whole + case when odds is null then 0 when upto <= left_ then 1
        when upto - size <= left_ and 2 * (left_ - (upto - size)) >= size then 1 else 0 end) as bigint) as taken
from ordered_docs
"""
)
def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, its source's words and target, and the words that the mix takes of it."""
    docs = table(spark, sf_dir, "documents")
    return mix_sources(docs, carry=docs.select("doc_id"))


def planted(doc_id: Column, text: Column) -> Column:
    """The text; of a tenth of the ids with its words repeated from some place on, by the contract of operator 11."""
    told = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(told / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")).otherwise(text)

    # The words are looked up many times, so they are made an argument first.
    return F.when((told % 10 == 0) & text.isNotNull(), F.get(F.transform(F.array(words), repeated), 0)).otherwise(text)


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its periodic runs, the longest one, and digests of all and of the collapsed text."""
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    order = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))
    best = F.array_min(order)
    return found.select("doc_id", "n_runs", lines.alias("lines"), best.alias("best"), "collapsed").select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        (-F.col("best.col1")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.col1") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its tokens under both tokenizers, their groups, and how usual its links are in the corpus."""
    docs = table(spark, sf_dir, "documents")
    found = align_tokenizers(docs, BYTE_TOKENIZER, PIECE_MODEL, carry=docs.select("doc_id"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
