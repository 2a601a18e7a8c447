"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import session
from orderlake.llm import (
    bloom_lm, byte_bpe, chat, decontaminate, langid, permutation_index, pii, prefix_trie, records, repair, simhash, syncmers, url_filter,
)
from orderlake.llm.common import stage, table

Query = Callable[[SparkSession, str], DataFrame]


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.prepare(spark)
    rules = url_filter.build(spark, spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op2_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(session.prepare(spark), sf_dir, "documents"))
    counts = [F.size(pii.of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans")
    )


def op3_length_delimited_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(session.prepare(spark), sf_dir, "documents")
    found = records.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return found.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op4_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = syncmers.compare(table(session.prepare(spark), sf_dir, "documents"))
    return found.withColumnRenamed("edited", "edited_sha256")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(session.prepare(spark), sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


TEST_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.prepare(spark)
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = given.union(spark.createDataFrame(TEST_TURNS, given.schema))
    output = stage(chat.render(turns), "chat")
    back = output.withColumn("blocks", chat.parsed(F.col("formatted")))
    listed = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t: F.concat(b["role"], F.lit("\n"), t, F.lit("\n")))))
    learned = chat.learned_text(F.col("formatted"), F.col("loss_spans"))
    return back.select("conv_id", "formatted", listed.alias("listed"), learned.alias("learned")).select(
        "conv_id", F.size("listed").cast("long").alias("n_turns"),
        F.sha2(F.array_join("listed", ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.prepare(spark)
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(session.prepare(spark), sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(session.prepare(spark), sf_dir, "documents")
    dictionaries = langid.learn(docs.filter(~langid.held_out()))
    found = langid.identify(docs.select("doc_id", "text"), dictionaries)
    return found.withColumn("held_out", langid.held_out()).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(session.prepare(spark), sf_dir, "documents")
    found = bloom_lm.score(docs, docs.filter(~bloom_lm.held_out()))
    return found.withColumn("held_out", bloom_lm.held_out())


def op11_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(session.prepare(spark), sf_dir, "embeddings")
    return permutation_index.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = repair.damage(table(session.prepare(spark), sf_dir, "conversations"))
    return repair.audits(damaged, "present")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(session.prepare(spark), sf_dir, "conversations")
    return prefix_trie.trie(prefix_trie.shared_openings(prefix_trie.paths(turns)))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_pii_weak_supervision,
        op3_length_delimited_records,
        op4_closed_syncmers,
        op5_byte_bpe,
        op6_chat_formatting,
        op7_benchmark_decontamination,
        op8_simhash_near_dedup,
        op9_language_id,
        op10_lm_scoring,
        op11_permutation_index,
        op12_conversation_repair,
        op13_conversation_trie,
    )
}

_WORDS = """list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"""



def _crc32(text: str) -> str:
    """DuckDB SQL for the CRC-32 of ASCII digits and colons: per byte an exclusive or, then eight shifts."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    fold = "lambda acc, x: case when x >= 0 then xor(acc, x) else xor(acc >> 1, 3988292384 * (acc & 1)) end"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), {fold}), 4294967295)"


ORACLES: dict[str, str] = {
    "op1_url_filter": """
with cut as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
u as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from cut),
rules(h, p, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits as (select page_id, host, path, h || p r, v from u left join rules
    on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, arg_max(r, length(r)) as rule, coalesce(arg_max(v, length(r)), 'allow') verdict
from fits group by page_id, host, path""",
    "op6_chat_formatting": """
with c as (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') t from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
o as (select *, row_number() over w k, lag(r) over w before,
    replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') e,
    replace(replace(replace(replace(r, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), '|', '&#124;') er
    from c window w as (partition by conv_id order by turn nulls first, r, t))
select conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' order by k)) turns_sha256,
    cast(coalesce(sum(length(t)) filter (r = 'assistant'), 0) as bigint) loss_chars,
    sha256(coalesce(string_agg(t, '' order by k) filter (r = 'assistant'), '')) loss_sha256,
    cast(sum(length(e) + case when before = r then 5 else length(er) + 11 end) as bigint) formatted_chars
from o group by conv_id""",
    "op7_benchmark_decontamination": f"""
with d as (select doc_id, coalesce({_WORDS}, []) w from documents),
b as (select item_id, {_WORDS} w from benchmark),
bw as (select distinct item_id, least(10, len(w)) n, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') k
    from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) s from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (select doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') k
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) s from d, sizes where len(w) >= n)),
hit as (select doc_id, s, n, item_id from dw join bw using (n, k)),
places as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + n)) p from hit) group by 1),
named as (select doc_id, count(distinct item_id) n_items,
    string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) ids from hit group by 1)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
    sha256(coalesce(ids, '')) items_sha256, n_hit is not null contaminated
from d left join places using (doc_id) left join named using (doc_id)""",
    # exact nearest: equal while every block is reranked whole, as at the small scales
    "op11_permutation_index": """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) e from embeddings
    where vec_id is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
pairs as (select q.vec_id query_id, v.vec_id,
    sqrt(list_reduce(list_transform(list_zip(q.e, v.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) score
    from v q join v on v.vec_id <> q.vec_id where q.vec_id % 100 = 0)
select query_id, cast(row_number() over (partition by query_id order by score, vec_id) as integer) rank, vec_id, score
from pairs qualify rank <= 10""",
    "op12_conversation_repair": f"""
with recursive given as (select conv_id, turn, coalesce(role, ' ') r, coalesce(text, ' ') t,
    {_crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 k from conversations),
damaged as (select conv_id, turn, case when k = 4 then 'user' else r end r,
    case when k = 1 then '' when k = 2 then regexp_replace(t, '[.!?]', '', 'g') else t end t,
    unnest(range(case when k = 3 then 2 else 1 end)) from given where k <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, r, t) i,
    trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) body from damaged),
marked as (select *, body = '' blank, body <> '' and row_number() over (partition by conv_id, r, t order by i) > 1 repeated,
    lag(r) over (partition by conv_id order by i) before from placed),
faults as (select *, not blank and not repeated and right(body, 1) not in ('.', '!', '?') cut,
    case when blank or repeated then 'x' when r[1:1] in ('s', 'u', 'a') then r[1:1] else 'o' end kind,
    coalesce(before is not null and (before[1:1] || r[1:1]) not in ('su', 'ua', 'au'), false) odd from marked),
counted as (select conv_id, max(i) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps,
    count(*) filter (blank) blank, count(*) filter (repeated) duplicate, count(*) filter (cut) truncated,
    count(*) filter (odd) illegal from faults group by conv_id),
-- per conversation and place the best cost and edits of each state, as text that compares by cost first
walk as (
    select conv_id, 0 i, 1000000 c0, '' e0, 9000000 c1, '' e1, 1000002 c2, 'I' e2, 1000004 c3, 'II' e3 from counted
    union all
    select conv_id, i, c0, e0, c1, e1, struct_extract(m2, 'c'), struct_extract(m2, 'e'),
        case when (struct_extract(m2, 'c') + 2, struct_extract(m2, 'e') || 'I') < (struct_extract(b3, 'c'), struct_extract(b3, 'e')) then struct_extract(m2, 'c') + 2 else struct_extract(b3, 'c') end,
        case when (struct_extract(m2, 'c') + 2, struct_extract(m2, 'e') || 'I') < (struct_extract(b3, 'c'), struct_extract(b3, 'e')) then struct_extract(m2, 'e') || 'I' else struct_extract(b3, 'e') end
    from (select *, least({{'c': struct_extract(b2, 'c'), 'e': struct_extract(b2, 'e')}}, {{'c': c0 + 2, 'e': e0 || 'I'}}, {{'c': c1 + 2, 'e': e1 || 'I'}},
            {{'c': struct_extract(b3, 'c') + 2, 'e': struct_extract(b3, 'e') || 'I'}}) m2
        from (select w.conv_id, f.i, w.c0 + 3 c0, w.e0 || 'D' e0,
            least({{'c': w.c1 + 3, 'e': w.e1 || 'D'}},
                {{'c': case when kind = 's' then w.c0 + cut::int else 9000000 end, 'e': w.e0 || 'K'}}) b1, struct_extract(b1, 'c') c1, struct_extract(b1, 'e') e1,
            least({{'c': w.c2 + 3, 'e': w.e2 || 'D'}},
                {{'c': case when kind = 'u' then w.c0 + cut::int else 9000000 end, 'e': w.e0 || 'K'}},
                {{'c': case when kind = 'u' then w.c1 + cut::int else 9000000 end, 'e': w.e1 || 'K'}},
                {{'c': case when kind = 'u' then w.c3 + cut::int else 9000000 end, 'e': w.e3 || 'K'}},
                {{'c': case when kind <> 'x' then w.c0 + 2 + cut::int else 9000000 end, 'e': w.e0 || 'R'}},
                {{'c': case when kind <> 'x' then w.c1 + 2 + cut::int else 9000000 end, 'e': w.e1 || 'R'}},
                {{'c': case when kind <> 'x' then w.c3 + 2 + cut::int else 9000000 end, 'e': w.e3 || 'R'}}) b2,
            least({{'c': w.c3 + 3, 'e': w.e3 || 'D'}},
                {{'c': case when kind = 'a' then w.c2 + cut::int else 9000000 end, 'e': w.e2 || 'K'}},
                {{'c': case when kind <> 'x' then w.c2 + 2 + cut::int else 9000000 end, 'e': w.e2 || 'R'}}) b3
            from walk w join faults f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1) s) s2),
done as (select c.*, least({{'c': w.c0, 'e': w.e0}}, {{'c': w.c3, 'e': w.e3}}) b
    from counted c join walk w on w.conv_id is not distinct from c.conv_id and w.i = c.n),
letters as (select conv_id, p, w[p:p] e, length(replace(w[1:p], 'I', '')) i, length(replace(w[1:p], 'D', '')) place
    from (select conv_id, struct_extract(b, 'e') w, unnest(range(1, length(w) + 1)) p from done)),
-- a system turn kept in front moves the others by one place
opened as (select l.conv_id, max(case when l.place = 1 and l.e = 'K' and r[1:1] = 's' then 1 else 0 end) s
    from letters l join faults f on f.conv_id is not distinct from l.conv_id and f.i = l.i group by l.conv_id),
lines as (select l.conv_id, l.p, case when l.e = 'K' then f.r when (l.place - o.s) % 2 = 1 then 'user' else 'assistant' end
    || ':' || case when l.e = 'I' then '' else f.t end line
    from letters l join opened o on o.conv_id is not distinct from l.conv_id
    left join faults f on f.conv_id is not distinct from l.conv_id and f.i = l.i where l.e <> 'D'),
texts as (select conv_id, string_agg(line, chr(10) order by p) whole from lines group by conv_id)
select g.conv_id, cast(coalesce(gaps, 0) as bigint) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate,
    coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal, cast(coalesce(struct_extract(d.b, 'c') - 1000000, 0) as bigint) as cost,
    coalesce(struct_extract(d.b, 'e'), '') audit, sha256(coalesce(whole, '')) repaired_sha256
from (select distinct conv_id from given) g left join done d on d.conv_id is not distinct from g.conv_id
    left join texts x on x.conv_id is not distinct from g.conv_id""",
    "op13_conversation_trie": f"""
with own as (select conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first) l
    from conversations where conv_id is not null group by conv_id),
built as (select o.conv_id, list_concat(coalesce(b.l[1:h], []), o.l[h + 1:]) l
    from (select *, {_crc32("cast(conv_id as varchar)")} % 6 h from own) o left join own b on b.conv_id = o.conv_id - o.conv_id % 100),
starts as (select conv_id, len(l) n, unnest(range(len(l) + 1)) depth, l from built),
keyed as (select conv_id, n, depth, sha256(cast(l[1:depth] as varchar)) k, sha256(cast(l[1:depth - 1] as varchar)) up,
    case when depth = 0 then 0 else length(l[depth].t) end size from starts),
nodes as (select depth, k, min(case when depth > 0 then up end) up, min(conv_id) conv_id, count(*) n_convs, any_value(size) size,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (n = depth), '')) ends_sha256
    from keyed group by depth, k),
kids as (select depth - 1 depth, up k, count(*) n from nodes where depth > 0 group by all),
full_nodes as (select n.*, coalesce(c.n, 0) n_children from nodes n left join kids c using (depth, k)),
-- each node under each of its ancestors, through any one of its members
under as (select n.depth, n.k, n.n_children, (n.n_convs - 1) * n.size saved, a.depth a_depth, a.k a_k
    from full_nodes n join keyed a on a.conv_id = n.conv_id and a.depth <= n.depth),
sums as (select a_depth depth, a_k k, count(*) filter (n_children = 0) n_leaves, sum(saved) saved_tokens from under group by all)
select n.conv_id, n.depth, p.conv_id parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
    cast(s.saved_tokens as bigint) saved_tokens, n.ends_sha256
from full_nodes n join sums s using (depth, k) left join nodes p on p.depth = n.depth - 1 and p.k = n.up""",
}
