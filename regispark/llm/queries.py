"""One query per operator over its whole test table, and the SQL that must agree where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regispark.llm import (
    binary,
    bpe,
    chat,
    fingerprint,
    html,
    language,
    lines,
    ngram_join,
    packing,
    periodic,
    quality,
    topk,
    trie,
)
from regispark.llm.frames import words

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Id that ends a document in token files.
END_ID = 2


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Shingles and component of near copies of every document."""
    return ngram_join.linked_components(table(spark, folder, "documents"))


@query()
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Bucket, batch and place of every document, by its words."""
    return packing.pack_documents(table(spark, folder, "documents"))


@query()
def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    import public_tokenizers

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, folder, "documents"), path, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


@query()
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    return language.identify(table(spark, folder, "documents"))


@query(
    rf"""
    with d as (select row_number() over () as r, doc_id, source, text, coalesce(text, '') as t from documents),
    w as (select r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
    win as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as k
            from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w)),
    dup as (select r, i from (select r, i, count(*) over (partition by r, k) as c from win) where c > 1),
    cov as (select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from dup) group by r),
    ln as (select distinct coalesce(source, '') as host, source is null as nohost, md5(text) as th, pos,
                  lower(trim(regexp_replace(ls[pos], '[\x20\x09-\x0D]+', ' ', 'g'))) as line
           from (select d.source, d.text, w.ls, unnest(range(1, len(w.ls) + 1)) as pos from d join w using (r))),
    often as (select host, nohost, line from ln group by all having count(distinct th) >= {quality.LINE_DOCS}),
    rest as (select ln.host, ln.nohost, th, sum(len(string_split(ln.line, ' '))) as n,
                    sum(case when o.line is null then len(string_split(ln.line, ' ')) else 0 end) as kept_words
             from ln left join often o on o.host = ln.host and o.nohost = ln.nohost and o.line = ln.line
             group by ln.host, ln.nohost, th),
    m as (select d.*, len(ws)::bigint as n_words,
                 length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
                 (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols,
                 (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
                 coalesce(cov.n, 0)::bigint as n_repeat_words
          from d join w using (r) left join cov using (r)),
    f as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words as base_failed from m)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and coalesce(kept_words >= {quality.MIN_LEFT} * n, true) as kept
    from f left join rest on rest.host = coalesce(f.source, '') and rest.nohost = (f.source is null) and rest.th = md5(f.text)
    """
)
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    return quality.judged(table(spark, folder, "documents"))


@query(
    rf"""
    with d as (select row_number() over () as r, doc_id, coalesce(source, '') as host, source is null as nohost, text,
                      string_split(coalesce(text, ''), chr(10)) as ls from documents),
    ln as (select r, host, nohost, md5(text) as th, pos, ls[pos] as line,
                  lower(trim(regexp_replace(ls[pos], '[\x20\x09-\x0D]+', ' ', 'g'))) as k
           from (select *, unnest(range(1, len(ls) + 1)) as pos from d)),
    often as (select host, nohost, k from ln where k <> '' group by all having count(distinct th) >= {quality.LINE_DOCS}),
    m as (select ln.*, o.k is not null as gone
          from ln left join often o on o.host = ln.host and o.nohost = ln.nohost and o.k = ln.k),
    g as (select r, (count(*) filter (gone))::bigint as n_removed_lines,
                 coalesce(sum(len(string_split(k, ' '))) filter (gone), 0)::bigint as n_removed_words,
                 coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '') as rest
          from m group by r)
    select doc_id, n_removed_lines, n_removed_words,
           case when text is not null then length(rest) end::bigint as n_left_chars,
           case when text is not null then sha256(rest) end as left_sha256
    from d join g using (r)
    """
)
def op5_boilerplate_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What every document loses with its boilerplate lines, and the text that is left."""
    return quality.removals(table(spark, folder, "documents"))


@query()
def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html.extracted(pages, html.learn(pages))


@query()
def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint.edited_fingerprints(table(spark, folder, "documents"))


MARKED = "</s>[INST] ok [/INST]"
_ESCAPE = chat.CONTROL.replace("'", "''")


@query(
    rf"""
    with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
               union all values (-1::bigint, 0::bigint, 'user', '{MARKED}'), (-1, 1, 'assistant', '{MARKED}')),
    o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as k from c),
    e as (select *, case when lag(role) over (partition by conv_id order by k) is distinct from role then 1 else 0 end as starts,
                 length(regexp_replace(replace(text, '\', '\\'), '{_ESCAPE}', '\1\3\\\2\4', 'g')) as n_text,
                 length(regexp_replace(replace(role, '\', '\\'), '{_ESCAPE}', '\1\3\\\2\4', 'g'))
                   + length(role) - length(replace(role, chr(10), '')) as n_role
          from o)
    select conv_id, count(*)::bigint as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
           sum(case when role = '{chat.TRAINED}' then length(text) else 0 end)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by k) filter (role = '{chat.TRAINED}'), '')) as loss_sha256,
           sum(n_text + starts * ({len(chat.START) + len(chat.END) + 2} + n_role) + (1 - starts) * {len(chat.APART)})::bigint
               as formatted_chars
    from e group by conv_id
    """
)
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every formatted conversation, and of one that is made of control strings."""
    made = [(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)]
    chats = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    one = spark.createDataFrame(made, "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.formatted(chats.unionByName(one)))


@query()
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text without later copies of repeated runs of lines."""
    return lines.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))


@query()
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written to token files and read back."""
    path = vocabulary("byte_bpe_50k.json")
    return binary.documents_read_back(table(spark, folder, "documents"), path, END_ID)


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` where the text of about every tenth document goes over, from some word on, into repeats of the
    words from there; by a hash of its id."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("bigint")
    n = F.size("_words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
    at = F.transform(
        F.sequence(F.lit(0).cast("bigint"), n - 1),
        lambda i: F.get("_words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")),
    )
    repeats = (h % 10 == 0) & (n > 0)
    rows = docs.withColumn("_words", F.when(h % 10 == 0, words(F.col("text"))))
    return rows.select("doc_id", F.when(repeats, F.array_join(at, " ")).otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every document, and digests of its text without the repeats."""
    return periodic.run_digests(with_repeats(table(spark, folder, "documents")))


@query(
    """
    with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
               where embedding is not null
                 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
          from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0)
    select query_id, rank::integer as rank, vec_id, score
    from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 10
    """
)
def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten rows with the highest inner product with every hundredth row."""
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), topk.whole_vectors(F.col("embedding")).alias("values"), (F.col("vec_id") % 100 == 0).alias("asked")
    )
    return topk.exact_top_k(rows)


_CRC32 = """list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::varchar, ''), lambda c: ord(c)::bigint)),
        lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))"""


@query(
    rf"""
    with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                      row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
                          md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as k
               from conversations where conv_id is not null),
    own as (select conv_id, list({{'role': role, 'text': text}} order by k) as turns from t group by conv_id),
    h as (select *, xor({_CRC32}, 4294967295) % 4 as h from own),
    re as (select h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) as turns
           from h left join own b on b.conv_id = h.conv_id - h.conv_id % 20),
    p as (select conv_id, len(turns) as n, d, turns[1:d] as path from (select *, unnest(range(0, len(turns) + 1)) as d from re)),
    node as (select path, d, min(conv_id) as conv_id, count(*) as n_convs,
                    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d), '')) as ends_sha256
             from p group by path, d),
    w as (select *, case when d = 0 then 0 else
                 len(list_filter(string_split_regex(path[d].text, '[ 	-
]+'), lambda x: x <> '')) end as words from node),
    kids as (select path[1:d - 1] as path, count(*) as n_children from node where d > 0 group by 1),
    f as (select w.*, coalesce(n_children, 0) as n_children from w left join kids using (path)),
    up as (select path[1:a] as path, sum((n_convs - 1) * words) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
           from (select *, unnest(range(0, d + 1)) as a from f) group by 1)
    select f.conv_id, f.d::bigint as depth, parent.conv_id as parent_conv_id, f.n_convs::bigint as n_convs, f.n_children::bigint as n_children,
           n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, f.ends_sha256
    from f join up using (path) left join f parent on f.d > 0 and parent.path = f.path[1:f.d - 1]
    """
)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the trie of all conversations, each opened like the first one of its group."""
    return trie.prefix_trie(trie.shared_openings(trie.conversations(table(spark, folder, "conversations"))))
