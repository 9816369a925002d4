"""The queries opN_* over whole tables, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontamination, fill_middle, language_id, line_dedup, pieces, prefix_trie, quality, resampling
from tidemark.llm import simhash, token_store, toxicity, warc
from tidemark.llm.common import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, fertility measures and verdict of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.annotate(docs).withColumn("reason", F.coalesce("reason", F.lit("")))


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaked benchmark items of every document."""
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_monolithic_gzip_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of every page, read back from the rewritten archives."""
    return warc.archive_and_read(_table(spark, sf_dir, "pages"))


def op4_hyperdimensional_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op5_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


#: A conversation whose texts hold the template's own marks.
CONFLICT = "\\### Assistant: </turn> ok"


def op6_grammar_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back from the formatted text."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONFLICT).alias("text"),
    )
    return chat.read_back(chat.format_conversations(rows.unionByName(extra)))


def op7_sentencepiece_shared_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The piece ids of every document, their number and whether they decode to the text."""
    return pieces.encode_documents(_table(spark, sf_dir, "documents"))


def op8_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and checksum of every document, read back from the token store."""
    return token_store.store_and_check(_table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, log_weight, key and selected of every document; the target are texts of good quality."""
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return resampling.resample(_table(spark, sf_dir, "documents"), good)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the kept text of every document."""
    kept = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    turns = prefix_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    nodes, ends = prefix_trie.prefix_trie(prefix_trie.with_shared_heads(written(turns, "trie-turns")))
    ended = prefix_trie.ends_digests(ends)
    digest = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return nodes.join(ended, "node", "left").drop("node").withColumn("ends_sha256", digest)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of the transformed and the restored text of every document."""
    made = fill_middle.transform(_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_tokeniser_fertility": op1_tokeniser_fertility,
    "op2_template_decontamination": op2_template_decontamination,
    "op3_monolithic_gzip_normaliser": op3_monolithic_gzip_normaliser,
    "op4_hyperdimensional_language_id": op4_hyperdimensional_language_id,
    "op5_noisy_channel_toxicity": op5_noisy_channel_toxicity,
    "op6_grammar_round_trip": op6_grammar_round_trip,
    "op7_sentencepiece_shared_prefix": op7_sentencepiece_shared_prefix,
    "op8_token_id_output": op8_token_id_output,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_line_dedup": op11_line_dedup,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {"op6_grammar_round_trip": r"""
        with rows as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
        ), f as (
            select *, '### ' || upper(role[1]) || role[2:] || ': '
                || regexp_replace(regexp_replace(text, '##(\\*)# ', '##\\\1# ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g') || ' </turn>' || chr(10) as line
            from rows
        )
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
            sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
            sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
            sum(length(line))::bigint as formatted_chars, true as round_trip
        from f group by conv_id
    """, "op3_monolithic_gzip_normaliser": """
        with p as (
            select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
            from pages
        ), f as (select *, min(page_id) over (partition by payload_digest) as first_id from p)
        select page_id, payload_bytes, payload_digest,
            case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
            case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
        from f
    """, "op11_line_dedup": """
        with l as (
            select doc_id, coalesce(text, '') as text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
            from documents
        ), k as (
            select *, translate(
                    trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
                ) as key
            from l
        ), f as (
            select key, max(doc_id) as last_id from k where length(key) >= 40
            group by key having count(distinct doc_id) >= 5
        ), m as (
            select k.*, f.key is not null and k.doc_id <> f.last_id as dropped from k left join f on k.key = f.key
        )
        select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
        from m group by doc_id
    """, "op12_conversation_prefix_trie": """
        with raw as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        ), own as (
            select conv_id, list({'role': role, 'text': text}
                    order by turn nulls first, role, sha256(length(role) || ':' || role || text)) as turns
            from raw group by conv_id
        ), rebuilt as (
            select c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) as turns
            from (
                select conv_id, turns, xor(4294967295, list_reduce(
                        [4294967295::bigint] || [ascii(x)::bigint for x in string_split(conv_id::varchar, '')],
                        lambda a, b: xor(a >> 8, list_reduce(
                            [xor(a & 255, b)] || range(8),
                            lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end
                        ))
                    )) % 9 as h
                from own
            ) c left join own b on b.conv_id = c.conv_id - c.conv_id % 5
        ), member as (
            select conv_id, turns, unnest(range(0, len(turns) + 1)) as depth from rebuilt
        ), node as (
            select turns[1:depth] as prefix, depth, min(conv_id) as conv_id, count(*) as n_convs,
                coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(turns) = depth), '') as ends
            from member group by all
        ), child as (
            select prefix[1:depth - 1] as prefix, depth - 1 as depth, count(*) as n_children
            from node where depth > 0 group by all
        ), own_sums as (
            select n.*, coalesce(c.n_children, 0) as n_children,
                case when n.depth > 0 then (n.n_convs - 1) * strlen(n.prefix[n.depth].text) else 0 end as saved
            from node n left join child c on n.prefix = c.prefix and n.depth = c.depth
        ), up as (
            select prefix, n_children, saved, unnest(range(0, depth + 1)) as above from own_sums
        ), subtree as (
            select prefix[1:above] as prefix, above as depth, count(*) filter (where n_children = 0) as n_leaves,
                sum(saved)::bigint as saved_tokens
            from up group by all
        )
        select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens,
            sha256(n.ends) as ends_sha256
        from own_sums n join subtree s on n.prefix = s.prefix and n.depth = s.depth
            left join node p on p.depth = n.depth - 1 and p.prefix = n.prefix[1:n.depth - 1]
    """, "op13_fill_in_middle": """
        with d as (
            select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256('1:' || doc_id::varchar) as g
            from documents
        ), h as (
            select *, ('0x' || g[1:8])::bigint as h1, ('0x' || g[9:16])::bigint as h2, ('0x' || g[17:24])::bigint as h3,
                ('0x' || g[25:32])::bigint as h4
            from d
        ), c as (
            select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
                case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                        or h3 % 100 >= 90 then 'plain'
                    when h4 % 100 < 20 then 'spm' else 'psm' end as form
            from h
        ), p as (
            select *, substring(text, 1, a) as prefix, substring(text, a + 1, b - a) as middle, substring(text, b + 1) as suffix
            from c
        )
        select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
            case when form <> 'plain' then b - a end as middle_chars,
            sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
            sha256(text) as restored_sha256
        from p
    """,}
