"""The registered queries of the operators, each over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import (
    brown, chat, decontamination, hard_negatives, hilbert, langid, line_frequency, packing, pii, prefix_trie, simhash, toxicity, url_rules,
)
from tabularium.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql.strip()
        return build

    return register


@query()
def op1_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.fit(docs, where=langid.training()))


@query()
def op2_brown_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(documents(spark, sf_dir))


@query(
    r"""
    with words as (
      select doc_id, regexp_extract_all(lower(text), '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]\p{M}*|(?:[^\P{L}\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]|\p{N}|\p{M})+') w from documents),
    items as (
      select item_id, regexp_extract_all(lower(text), '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]\p{M}*|(?:[^\P{L}\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]|\p{N}|\p{M})+') w from benchmark),
    d as (select doc_id, unnest(w) token, unnest(range(len(w))) pos from words),
    i as (select item_id, len(w) n, unnest(w) token, unnest(range(len(w))) pos from items where len(w) >= 5),
    same as (select doc_id, item_id, n, d.pos - i.pos shift, i.pos from d join i using (token)),
    runs as (
      select doc_id, item_id, n, count(*) over (
        partition by doc_id, item_id, shift order by pos range between current row and 14 following) equal
      from same)
    select doc_id, item_id, cast(least(n, 15) as int) n_window, cast(max(equal) as int) n_equal
    from runs group by doc_id, item_id, n
    having max(equal) >= case when n < 8 then n else ceil(least(n, 15) * 0.8 - 1e-9) end
    """
)
def op3_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query()
def op4_simhash_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query()
def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.shard_documents(documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")


@query(
    r"""
    with w as (
      select doc_id, coalesce(text, '') t, [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] w,
        [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] l
      from documents),
    g as (
      select doc_id, unnest(range(len(w) - 2)) i, unnest([[w[j + 1], w[j + 2], w[j + 3]] for j in range(len(w) - 2)]) g
      from w where len(w) >= 3),
    r as (select doc_id, i from g qualify count(*) over (partition by doc_id, g) > 1),
    c as (select doc_id, count(distinct p) n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) p from r) group by 1),
    lines as (
      select doc_id, source, unnest([x for x in [
        trim(y, ' ' || chr(9) || chr(11) || chr(12) || chr(13))
        for y in string_split(regexp_replace(lower(coalesce(text, '')), '[0-9]+', '0', 'g'), chr(10))] if x <> '']) line
      from documents),
    often as (select source, line from lines group by all having count(distinct doc_id) > 20),
    lost as (
      select doc_id, sum(length(line)) line_chars,
        coalesce(sum(length(line)) filter ((source, line) in (select (source, line) from often)), 0) removed_chars
      from lines group by 1),
    base as (
      select doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars,
        cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) n_symbols, cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines,
        cast(coalesce(n_repeat_words, 0) as bigint) n_repeat_words
      from w left join c using (doc_id))
    select base.*, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed,
      not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and removed_chars * 2 <= line_chars kept
    from base left join lost using (doc_id)
    """
)
def op6_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.judge(documents(spark, sf_dir)).drop("line_chars", "removed_chars")


@query(
    r"""
    with parts as (
      select page_id, lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)) host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) path
      from pages),
    rules(verdict, rule_host, rule_path) as (
      values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
    fits as (
      select page_id, verdict, rule_host || rule_path as fit
      from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
      qualify row_number() over (partition by page_id order by length(fit) desc) = 1)
    select page_id, host, path, fit as "rule", coalesce(verdict, 'allow') verdict from parts left join fits using (page_id)
    """
)
def op7_url_rule_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.match(spark.read.parquet(f"{sf_dir}/pages.parquet"), url_rules.RULES)


@query(
    r"""
    with turns as (
      select conv_id, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1 place, role, text
      from (select distinct conv_id, turn, role, text from conversations where conv_id is not null)),
    whole as (select conv_id, list({'r': role, 't': text} order by place) l from turns group by 1),
    kept as (
      select conv_id from whole a where not exists (
        select 1 from whole b
        where b.l[1:len(a.l)] = a.l and (len(b.l) > len(a.l) or len(b.l) = len(a.l) and b.conv_id < a.conv_id)))
    select conv_id, cast(place // 256 as bigint) segment, cast(count(*) as bigint) n_turns,
      string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10), '' order by place) as text
    from turns join kept using (conv_id) group by 1, 2
    """
)
def op8_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query()
def op9_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.fit(docs))


@query()
def op10_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset"))


@query()
def op11_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query(
    r"""
    with turns as (
      select conv_id, coalesce(role, '') r, coalesce(text, '') t,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) p
      from conversations where conv_id is not null),
    own as (select conv_id, list({'r': r, 't': t} order by p) l from turns group by 1),
    bits(n, c) as (
      with recursive step(n, k, c) as (
        select range, 0, cast(range as bigint) from range(256)
        union all
        select n, k + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from step where k < 8)
      select n, c from step where k = 8),
    digits as (
      with recursive step(conv_id, s, k, c) as (
        select conv_id, cast(conv_id as varchar), 1, cast(4294967295 as bigint) from own
        union all
        select conv_id, s, k + 1, xor(step.c // 256, bits.c)
        from step join bits on bits.n = xor(step.c, cast(ascii(substr(s, k, 1)) as bigint)) & 255 where k <= length(s))
      select conv_id, xor(c, 4294967295) % 4 h from step where k = length(s) + 1),
    whole as (
      select o.conv_id, list_concat(coalesce(b.l[1:h], []), coalesce(o.l[h + 1:], [])) l
      from own o join digits using (conv_id) left join own b on b.conv_id = o.conv_id - o.conv_id % 20),
    path as (select conv_id, l, unnest(range(len(l) + 1)) d from whole),
    member as (select conv_id m, d, l[1:d] l, len(l) = d ends from path),
    node as (
      select d, l, min(m) conv_id, count(*) n,
        coalesce(string_agg(m::varchar, ',' order by m) filter (ends), '') ends,
        case when d = 0 then 0 else len([x for x in regexp_split_to_array(l[d].t, '[\x20\x09-\x0D]+') if x <> '']) end w
      from member group by d, l),
    child as (select d - 1 d, l[1:d - 1] l, count(*) c from node where d > 0 group by all),
    leafy as (select n.*, coalesce(c, 0) c from node n left join child using (d, l)),
    above as (
      select x.d, x.l[1:x.d] l, count(*) filter (x.c = 0) n_leaves, sum(x.saved) saved
      from (select unnest(range(u.d + 1)) d, u.l, u.c, (u.n - 1) * u.w saved from leafy u) x group by 1, 2)
    select n.conv_id, cast(n.d as bigint) as "depth", p.conv_id parent_conv_id, cast(n.n as bigint) n_convs, cast(n.c as bigint) n_children,
      cast(a.n_leaves as bigint) n_leaves, cast(a.saved as bigint) saved_tokens, sha256(n.ends) ends_sha256
    from leafy n join above a using (d, l) left join node p on p.d = n.d - 1 and p.l = n.l[1:n.d - 1]
    """
)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query(
    """
    with rows as (
      select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
        [floor(256 * cast(x as double)) for x in embedding] v
      from embeddings
      where vec_id is not null and label is not null and embedding is not null and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
    pairs as (
      select a.vec_id anchor_id, c.vec_id, a.label = c.label same, cast(list_inner_product(a.v, c.v) as bigint) score
      from rows a join rows c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0),
    positives as (
      select anchor_id, vec_id positive_id, score positive_score from pairs where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as int) as "rank",
      vec_id negative_id, positive_score, score negative_score
    from positives join pairs using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
    qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 3
    """
)
def op13_four_russians_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
