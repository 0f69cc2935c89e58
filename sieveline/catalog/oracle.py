"""DuckDB SQL that the registered queries must agree with.

``VIEWS`` are the inputs and shared intermediate results; ``sql`` puts those a
statement needs in front of it as common table expressions.
"""

from __future__ import annotations

import re

from sieveline.catalog.inputs import DOMAINS, LETTERS, SEED_TEXTS, SEEDS
from sieveline.config import CONDITIONS
from sieveline.operators.answers import ABSTENTION_PHRASES, INSTRUCTIONS, NO_PASSAGES
from sieveline.operators.abtest import PROPORTIONS, TESTS
from sieveline.operators.grounding import DIRECTIONAL_SWAPS
from sieveline.plans.evaluation import CONDITIONS as ABLATION

WS_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SWAPS = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in DIRECTIONAL_SWAPS.items()) + "}"


def listed(values: object) -> str:
    return "[" + ", ".join(lit(v) if isinstance(v, str) else str(v) for v in values) + "]"


def hexint(md5: str, start: int, length: int) -> str:
    return f"('0x' || substr({md5}, {start}, {length}))::bigint"


def tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda x: x <> '')"


def full(title: str = "title", text: str = "text") -> str:
    return f"(case when {title} <> '' then {title} || ' ' || {text} else {text} end)"


def stripped(text: str) -> str:
    return f"trim({text}, {WS_CHARS})"


def chunked(source: str) -> str:
    return f"""
    select doc_id || '__chunk' || (s // 140) as chunk_id, doc_id, orig_id, domain, title, ingest_seq,
           case when n <= 180 then ft else array_to_string(toks[s + 1 : s + 180], ' ') end as text,
           s as start_token, least(s + 180, n) as end_token
    from (select *, unnest(starts) as s
          from (select *, case when n <= 180 then [0::bigint]
                          else range(0, (ceil((n - 180) / 140.0) * 140)::bigint + 1, 140) end as starts
                from (select *, len(toks) as n
                      from (select *, {tokens('ft')} as toks
                            from (select *, {full()} as ft from {source})))))"""


def bm25(pairs: str, k: int) -> str:
    return f"""
    select * from (
      select *, row_number() over (partition by query_id, domain order by bm25_score desc, chunk_id) as rank
      from (select q.query_id, q.domain, p.doc_id, p.chunk_id,
                   round(sum(q.qtf * t.idf * p.tf * 2.5 / (p.tf + 1.5 * (0.25 + 0.75 * p.dl / c.avgdl))), 6)
                     as bm25_score
            from (select query_id, domain, term, count(*) as qtf
                  from (select query_id, domain, unnest({tokens('text')}) as term from {pairs})
                  group by all) q
            join f_terms t on t.domain = q.domain and t.term = q.term
            join f_len c on c.domain = q.domain
            join f_postings p on p.domain = q.domain and p.term = q.term
            group by q.query_id, q.domain, p.doc_id, p.chunk_id)
      where bm25_score > 0) where rank <= {k}"""


def dense(pairs: str, corpus: str, k: int) -> str:
    return f"""
    select * from (
      select *, row_number() over (partition by query_id, domain order by score desc, chunk_id) as rank
      from (select q.query_id, q.domain, v.doc_id, v.chunk_id,
                   round(list_inner_product(q.embedding::double[], v.embedding::double[]), 6) as score
            from {pairs} q join {corpus} v on v.domain = q.domain))
    where rank <= {k}"""


def rrf(source: str, group: str, k: str = "60", topk: int = 100) -> str:
    """Fusion of ``source`` rows by ``group`` columns and document."""
    domain = "" if re.search(r"\bdomain\b", group) else "b.domain as domain,"
    return f"""
    select {group}, doc_id, b.chunk_id as chunk_id, {domain} b.score as score, b.bm25_score as bm25_score,
           fused_score, rank
    from (select *, row_number() over (partition by {group} order by fused_score desc, f.list_ord, f.rank, doc_id)
                   as rank
          from (select {group}, doc_id, round(sum(1.0::double / ({k} + rank)), 9) as fused_score,
                       arg_min({{'chunk_id': chunk_id, 'domain': domain, 'score': score,
                                 'bm25_score': bm25_score}},
                               row(rank, list_ord, chunk_id)) as b,
                       min({{'list_ord': list_ord, 'rank': rank}}) as f
                from {source} group by {group}, doc_id))
    where rank <= {topk}"""


def reranked(source: str, cap: int, group: str = "query_id") -> str:
    return f"""
    select * exclude (rank, o, e), case when rank <= {cap} then e end as rerank_score, o as rank
    from (select *, row_number() over (partition by {group} order by (rank <= {cap}) desc,
                     case when rank <= {cap} then e end desc nulls last, rank) as o
          from (select c.*, s.score as e from {source} c left join f_ext s using (query_id, doc_id)))"""


def run(source: str, group: str = "query_id") -> str:
    return f"""
    select {group}, regexp_replace(doc_id, '^(.*)__chunk.*$', '\\1') as doc_id,
           max(coalesce(case when rerank_score > 0 then rerank_score end,
                        case when fused_score > 0 then fused_score end, score)) as run_score
    from {source} group by all"""


def ir_metrics(source: str, by: str = "", values: str = "") -> str:
    """Per-query metrics of a run; ``values`` lists all conditions of ``by``."""
    c = f"{by}, " if by else ""
    on = f"f.{by} = r0.{by} and " if by else ""
    conditions = f"(select unnest({values}) as {by}) r0 cross join" if by else ""
    keep = f"r0.{by}," if by else ""
    return f"""
    select {keep} j.query_id,
           case when idcg > 0 then coalesce(dcg, 0) / idcg else 0.0 end as ndcg_10,
           coalesce(1.0::double / first_hit, 0.0) as rr_10,
           case when n_relevant > 0 then coalesce(found_100, 0)::double / n_relevant else 0.0 end as r_100,
           case when n_relevant > 0 then coalesce(found_1000, 0)::double / n_relevant else 0.0 end as r_1000
    from {conditions}
      (select query_id, sum(case when i <= 10 then greatest(relevance, 0) / log2(i + 1.0) end) as idcg,
              count_if(relevance >= 1) as n_relevant
       from (select *, row_number() over (partition by query_id order by relevance desc, doc_id) as i from f_qrels)
       group by query_id) j
    left join
      (select {c} query_id, sum(case when i <= 10 then greatest(relevance, 0) / log2(i + 1.0) end) as dcg,
              min(case when relevance >= 1 and i <= 10 then i end) as first_hit,
              count_if(relevance >= 1 and i <= 100) as found_100,
              count_if(relevance >= 1 and i <= 1000) as found_1000
       from (select {c} query_id, doc_id,
                    row_number() over (partition by {c} query_id order by run_score desc, doc_id desc) as i
             from {source}) join f_qrels using (query_id, doc_id)
       group by all) f on {on} f.query_id = j.query_id"""


DOMAIN_MEANS = (
    "count(*) as n_queries, avg(ndcg_10) as ndcg_10, avg(rr_10) as rr_10, avg(r_100) as r_100, "
    "avg(r_1000) as r_1000"
)


def encoded(text: str) -> str:
    counts = f"list_transform({listed(LETTERS)}, lambda c: (length(lower({text})) - length(replace(lower({text}), c, '')))::double)"
    return f"(select list_transform(v, lambda x: case when n > 0 then x / n else 0.0 end) from (select v, sqrt(list_inner_product(v, v)) as n from (select {counts} as v)))"


def sentence_list(text: str) -> str:
    marked = f"regexp_replace({text}, '([.!?])\\s+', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {stripped('s')}), lambda s: length(s) >= 25)"


def wilson(k: str, n: str) -> tuple[str, str]:
    p = f"({k}::double / {n})"
    d = f"(1 + 3.8416 / {n})"
    centre = f"(({p} + 3.8416 / (2 * {n})) / {d})"
    margin = f"(1.96 * sqrt({p} * (1 - {p}) / {n} + 3.8416 / (4.0 * {n} * {n})) / {d})"
    return (
        f"case when {n} > 0 then round(greatest(0.0, {centre} - {margin}), 6) end",
        f"case when {n} > 0 then round(least(1.0, {centre} + {margin}), 6) end",
    )


PROBS = ", ".join(
    f"(1.0 + {hexint(f'md5(query_id || {lit(chr(124) + d)})', 1, 4)} % 1000) ** 2 * "
    f"(case when domain = {lit(d)} then 4.0 else 1.0 end)"
    for d in DOMAINS
)

ROUTES = {
    "broadcast": listed(DOMAINS),
    "routed_with_general": (
        f"list_filter({listed(DOMAINS)}, lambda d: d = top1_domain or d = 'en' "
        "or (top1_prob < 0.45 and d = top2_domain))"
    ),
    "routed_only": (
        f"list_filter({listed(DOMAINS)}, lambda d: d = top1_domain or (top1_prob < 0.45 and d = top2_domain))"
    ),
}

VIEWS: dict[str, str] = {
    "f_docs": """
    select lang || ':' || doc_id as doc_id, doc_id::varchar as orig_id, lang as domain,
           case when strpos(text, chr(10)) between 2 and 81 then substr(text, 1, strpos(text, chr(10)) - 1)
                else '' end as title,
           text, doc_id as ingest_seq from documents""",
    "f_raw": """
    select doc_id, orig_id, domain, title, text, ingest_seq * 4 + 2 as ingest_seq from f_docs
    union all
    select doc_id, orig_id, domain, null, text || ' copy', ingest_seq * 4 + 3 from f_docs
    union all
    select d.doc_id, d.orig_id, d.domain, d.title,
           case when l.toxic = 1 then null else '  ' || chr(9) || chr(10) end, ingest_seq * 4
    from f_docs d join labels l on l.doc_id::varchar = d.orig_id""",
    "f_cleaned": f"""
    select doc_id, orig_id, domain, {stripped("coalesce(title, '')")} as title,
           {stripped("coalesce(text, '')")} as text, ingest_seq
    from f_raw where {stripped("coalesce(text, '')")} <> ''""",
    "f_clean": """
    select * exclude rn from
      (select *, row_number() over (partition by doc_id order by ingest_seq) as rn from f_cleaned) where rn = 1""",
    "f_docs_clean": f"""
    select doc_id, orig_id, domain, {stripped('title')} as title, {stripped('text')} as text, ingest_seq
    from f_docs where {stripped('text')} <> ''""",
    "f_chunks": chunked("f_docs_clean"),
    "f_raw_chunks": chunked("f_clean"),
    "f_tokens": f"""
    select domain, doc_id, chunk_id, len(t) as dl, t
    from (select domain, doc_id, chunk_id, {tokens(f'lower({full()})')} as t from f_chunks)""",
    "f_postings": """
    select domain, doc_id, chunk_id, dl, term, count(*) as tf
    from (select domain, doc_id, chunk_id, dl, unnest(t) as term from f_tokens) group by all""",
    "f_len0": "select domain, count(*) as n_chunks, avg(dl) as avgdl from f_tokens group by domain",
    "f_raw_idf": """
    select domain, term, df, ln(n_chunks - df + 0.5) - ln(df + 0.5) as raw_idf
    from (select domain, term, count(*) as df from f_postings group by all) join f_len0 using (domain)""",
    "f_len": """
    select * from f_len0 join (select domain, avg(raw_idf) as avg_idf from f_raw_idf group by domain) using (domain)""",
    "f_terms": """
    select domain, term, df, case when raw_idf < 0 then 0.25 * avg_idf else raw_idf end as idf
    from f_raw_idf join f_len using (domain)""",
    "f_pages": """
    select page_id, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1) as domain,
           regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) as orig_id,
           regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as text from pages""",
    "f_rawq": """
    select domain || ':q' || page_id as query_id, text, domain from f_pages
    union all select 'en:b' || item_id, text, 'en' from benchmark""",
    "f_queries": f"""
    select query_id, {stripped("regexp_replace(regexp_replace(lower(text), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', ' ', 'g'), '\\s+', ' ', 'g')")}
           as text, domain from f_rawq""",
    "f_qrels": """
    select p.domain || ':q' || page_id as query_id, d.doc_id, (1 + coalesce(l.quality, 0))::int as relevance
    from f_pages p join f_docs d on d.domain = p.domain and d.orig_id = p.orig_id
    left join labels l on l.doc_id::varchar = d.orig_id
    union all
    select p.domain || ':q' || page_id, d.doc_id, coalesce(l.toxic, 0)::int
    from f_pages p join f_docs d on d.orig_id = p.page_id::varchar
    left join labels l on l.doc_id::varchar = d.orig_id where p.orig_id <> p.page_id::varchar""",
    "f_probs": f"""
    select query_id, domain, list_transform(w, lambda x: round(x / (w[1] + w[2] + w[3] + w[4]), 6)) as p
    from (select query_id, domain, [{PROBS}] as w from f_rawq)""",
    "f_classified": f"""
    select query_id, any_value(domain) as domain, max(case when o = 1 then d end) as top1_domain,
           max(case when o = 1 then x end) as top1_prob, max(case when o = 2 then d end) as top2_domain,
           max(case when o = 2 then x end) as top2_prob
    from (select *, row_number() over (partition by query_id order by x desc, d) as o
          from (select query_id, domain, unnest(p) as x, unnest({listed(DOMAINS)}) as d from f_probs))
    group by query_id""",
    "f_routed": f"""
    select query_id, text, unnest({ROUTES['routed_with_general']}) as domain
    from f_queries join f_classified using (query_id)""",
    "f_everywhere": f"select query_id, text, unnest({listed(DOMAINS)}) as domain from f_queries",
    "f_vectors": """
    select 'd' || (label % 3) || ':' || vec_id || '__chunk0' as chunk_id, 'd' || (label % 3) || ':' || vec_id as doc_id,
           'd' || (label % 3) as domain, embedding, vec_id, label from embeddings""",
    "f_vq": "select 'v' || vec_id as query_id, domain, embedding from f_vectors",
    "f_dvec": f"select chunk_id, doc_id, domain, {encoded('text')} as embedding from f_chunks",
    "f_qvec": f"select query_id, {encoded('text')} as embedding from f_rawq",
    "f_vec_hits": dense("f_vq", "f_vectors", 10),
    "f_bm25_own": bm25("f_queries", 100),
    "f_bm25": bm25("f_routed", 100),
    "f_bm25_all": bm25("f_everywhere", 100),
    "f_bm25_deep": bm25("f_queries", 1000),
    "f_dense": dense("(select query_id, domain, embedding from f_routed join f_qvec using (query_id))", "f_dvec", 100),
    "f_dense_all": dense("(select query_id, domain, embedding from f_everywhere join f_qvec using (query_id))", "f_dvec", 100),
    "f_dense_deep": dense("(select query_id, domain, embedding from f_queries join f_qvec using (query_id))", "f_dvec", 1000),
    **{
        f"f_lists{s}": f"""
    select query_id, domain, doc_id, chunk_id, score, 0.0::double as bm25_score, rank, 0 as list_ord from f_dense{s}
    union all
    select query_id, domain, doc_id, chunk_id, 0.0::double, bm25_score, rank, 1 from f_bm25{s}"""
        for s in ("", "_all", "_deep")
    },
    "f_stage1": rrf("f_lists", "query_id, domain"),
    "f_stage2": f"select *, list_position({listed(DOMAINS)}, domain) as list_ord from f_stage1",
    "f_fused": rrf("f_stage2", "query_id"),
    "f_mixed": """
    select * from f_lists where domain in ('en', 'fr') or (domain = 'de' and list_ord = 0) or (domain = 'es' and list_ord = 1)""",
    "f_mixed_both": "select * from f_mixed where domain in ('en', 'fr')",
    "f_mixed1": rrf("f_mixed_both", "query_id, domain"),
    "f_mixed2": f"""
    select query_id, domain, doc_id, chunk_id, score, bm25_score, rank, list_position({listed(DOMAINS)}, domain) as list_ord from (
      select query_id, domain, doc_id, chunk_id, score, bm25_score, rank from f_mixed1
      union all select query_id, domain, doc_id, chunk_id, score, bm25_score, rank from f_mixed where domain in ('de', 'es'))""",
    "f_mixed_fused": rrf("f_mixed2", "query_id"),
    "f_single": rrf("f_lists", "query_id"),
    "f_ext": f"""
    select * from (
      select query_id, doc_id, round({hexint("md5(query_id || '|' || doc_id)", 1, 4)} / 65536.0 * 4.0 - 2.0, 6) as score
      from (select distinct query_id, doc_id from f_lists_all)) where score <= 1.4""",
    "f_final": reranked("f_fused", 50),
    "f_own_run": "select query_id, doc_id, max(bm25_score) as run_score from f_bm25_own group by all",
    "f_own_metrics": ir_metrics("f_own_run"),
    "f_own_domain": f"select domain, {DOMAIN_MEANS} from f_own_metrics join f_rawq using (query_id) group by domain",
    "f_samples": f"""
    select query_id, text, domain from (
      select *, row_number() over (partition by domain order by md5('42|' || query_id), query_id) as r
      from f_queries where query_id in (select query_id from f_qrels)
        and (6 * ({hexint('md5(query_id)', 1, 8)} + {hexint('md5(query_id)', 9, 8)} + {hexint('md5(query_id)', 17, 8)})
             + {hexint('md5(query_id)', 25, 8)}) % 10 >= 7) where r <= 200""",
    "f_judged": f"""
    select query_id, doc_id, rank, {hexint("md5(query_id || '|' || doc_id)", 1, 2)} % 3 as judged
    from f_final where rank <= 10""",
    "f_cross": f"""
    select query_id, text, case h % 3 when 0 then []::varchar[] when 1 then [ds[h % 4 + 1]]
           else [ds[h % 4 + 1], ds[(h + 1) % 4 + 1]] end as expected_domains
    from (select *, {hexint('md5(query_id)', 1, 2)} as h, {listed(DOMAINS)} as ds from f_queries)""",
    "f_judgements": f"""
    select query_id, doc_id, (h % 3)::int as score, seq
    from (select query_id, doc_id, seq, {hexint("md5(query_id || '|' || doc_id || '|' || seq)", 1, 4)} as h
          from f_qrels, (select unnest([1, 2]::bigint[]) as seq)) where h < 36000""",
    "f_answer_turns": f"""
    select conv_id, turn, text, {hexint("md5(conv_id || '|' || turn)", 1, 1)} as h,
           ((turn - 1) // 2)::int as nth from conversations where role = 'assistant'""",
    "f_answers": f"""
    select query_id, condition, seed, answer, latency_ms,
           case when condition = 'no_retrieval' then [] else coalesce(passages, []) end as passages
    from (select 'c' || a.conv_id as query_id, {listed(CONDITIONS)}[nth % 6 + 1] as condition, 42 + nth // 6 as seed,
                 case when h = 15 then 'I don''t know.' else
                   (case h when 0 then 'SUPPORTED. ' when 1 then 'Refuted: ' when 2 then 'Not enough info. '
                           when 3 then 'UNSUPPORTED ' else '' end) || a.text ||
                   (case when h < 5 then ' [P1] is the source of this.' when h < 9 then ' [P3] [P1] [P9]' else '' end)
                 end as answer, length(a.text)::double as latency_ms, passages,
                 row_number() over (partition by a.conv_id, nth order by turn) as r
          from f_answer_turns a left join
            (select conv_id, list({{'doc_id': 'c' || conv_id || ':' || turn,
                                    'title': case when turn = 0 then 'opening' else '' end,
                                    'text': text}} order by turn, text) as passages
             from (select *, row_number() over (partition by conv_id order by turn, text) as r
                   from conversations where role <> 'assistant') where r <= 5 group by conv_id) p on p.conv_id = a.conv_id)
    where r = 1""",
    "f_marked": f"""
    select *, regexp_matches(lower(answer), {lit('|'.join(ABSTENTION_PHRASES))}) as abstained,
           list_filter(list_transform(regexp_extract_all(answer, '\\[P(\\d+)\\]', 1), lambda n: n::int),
                       lambda i: i between 1 and len(passages)) as marks from f_answers""",
    "f_cited": """
    select query_id, condition, seed, doc_id, first_seen from (
      select query_id, condition, seed, passages[m].doc_id as doc_id, min(pos) as first_seen
      from (select query_id, condition, seed, passages, unnest(marks) as m, unnest(range(1, len(marks) + 1)) as pos
            from f_marked) group by all)""",
    "f_shown": """
    select query_id, condition, seed, p.doc_id as doc_id, p.title as title, p.text as text, pos
    from (select query_id, condition, seed, unnest(passages) as p, unnest(range(1, len(passages) + 1)) as pos
          from f_answers)""",
    "f_cited_text": f"""
    select c.query_id, c.condition, c.seed, c.doc_id, s.text
    from f_cited c join (select query_id, condition, seed, doc_id, arg_max(text, pos) as text from f_shown group by all) s
      using (query_id, condition, seed, doc_id) where {stripped('s.text')} <> ''""",
    "f_similar": f"""
    select a.* exclude v, case when {stripped('a.answer')} <> '' and {stripped("coalesce(b.answer, '')")} <> ''
             then round(list_inner_product(a.v, b.v), 6) else 0.0 end as similarity_to_normal
    from (select *, {encoded('answer')} as v from f_marked) a
    left join (select query_id, seed, answer, {encoded('answer')} as v from f_answers where condition = 'normal') b
      using (query_id, seed)""",
    "f_typed": """
    select s.*, similarity_to_normal < 0.9 as answer_changed,
           case when s.condition = 'normal' then 'reference'
                when coalesce(n.abstained, true) and s.abstained then 'both_abstain'
                when coalesce(n.abstained, true) or s.abstained then 'abstention_shift'
                when similarity_to_normal < 0.9 then 'content_change' else 'both_answer_same' end as response_type
    from f_similar s left join (select query_id, seed, abstained from f_marked where condition = 'normal') n
      using (query_id, seed)""",
    "f_said_pos": f"""
    select query_id, condition, seed, pos, {encoded('sentence')} as v from (
      select query_id, condition, seed, unnest(s) as sentence, unnest(range(len(s))) as pos
      from (select query_id, condition, seed, {sentence_list('answer')} as s
            from f_marked where not abstained and len(passages) > 0))""",
    "f_faith": f"""
    select query_id, condition, seed, avg(case when best >= 0.7 then 1.0 else 0.0 end) as sentence_faithfulness
    from (select a.query_id, a.condition, a.seed, a.pos, max(round(list_inner_product(a.v, p.v), 6)) as best
          from f_said_pos a left join
            (select query_id, condition, seed, {encoded('text')} as v from f_shown where {stripped('text')} <> '') p
            using (query_id, condition, seed) group by all)
    group by all""",
    "f_support": f"""
    select m.query_id, m.condition, m.seed,
           case when c.n_cited is null then 0.0
                when len({sentence_list('m.answer')}) > 0 then coalesce(k.n_supported, 0)::double / c.n_cited end
             as citation_support
    from (select * from f_marked where not abstained and len(passages) > 0 and len(marks) > 0) m
    left join (select query_id, condition, seed, count(*) as n_cited from f_cited_text group by all) c
      using (query_id, condition, seed)
    left join (
      select query_id, condition, seed, count_if(best >= 0.7) as n_supported
      from (select a.query_id, a.condition, a.seed, p.doc_id, max(round(list_inner_product(a.v, p.v), 6)) as best
            from f_said_pos a join
              (select query_id, condition, seed, doc_id, {encoded('sentence')} as v from
                 (select query_id, condition, seed, doc_id, unnest({sentence_list('text')}) as sentence from f_cited_text)) p
              using (query_id, condition, seed) group by all)
      group by all) k using (query_id, condition, seed)""",
    "f_grounding": """
    select t.query_id, t.condition, t.seed, t.answer, t.abstained, t.similarity_to_normal, t.answer_changed,
           t.response_type, f.sentence_faithfulness, c.citation_support, t.latency_ms
    from f_typed t left join f_faith f using (query_id, condition, seed)
    left join f_support c using (query_id, condition, seed)""",
    "f_arm_base": """
    select arm, query_id, condition, seed, k % 10 = 0 as abstained, k / 100.0::double as similarity_to_normal,
           k / 100.0::double < 0.9 as answer_changed,
           case when k % 10 <> 0 then least(value / 100.0, 1.0) end as sentence_faithfulness,
           case when k % 10 <> 0 and k % 4 <> 0 then (k % 5) / 4.0::double end as citation_support,
           value as latency_ms
    from (select *, 41 + row_number() over (partition by arm, query_id, condition order by event_id) as seed
          from (select case when event_id % 2 = 0 then 'control' else 'treatment' end as arm, 'u' || user_id as query_id,
                       case when json_extract(props, '$.k')::int % 7 = 3 then 'no_retrieval'
                            when event_type = 'view' then 'normal' when event_type = 'click' then 'swapped_context'
                            when event_type = 'purchase' then 'random_in_domain'
                            when event_type = 'signup' then 'shuffled_order'
                            when event_type = 'error' then 'corrupted_context' end as condition,
                       event_id, value, json_extract(props, '$.k')::int as k from events)
          where condition is not null)""",
    "f_arms": """
    select a.*, case when a.condition = 'normal' then 'reference'
                when coalesce(n.abstained, true) and a.abstained then 'both_abstain'
                when coalesce(n.abstained, true) or a.abstained then 'abstention_shift'
                when a.similarity_to_normal < 0.9 then 'content_change' else 'both_answer_same' end as response_type
    from f_arm_base a left join
      (select arm, query_id, seed, abstained from f_arm_base where condition = 'normal') n using (arm, query_id, seed)""",
    "f_summary": """
    select arm, condition, count(*) as n_rows, avg(answer_changed::int) as answer_change_rate,
           avg(similarity_to_normal) as mean_similarity, count_if(abstained) as ab,
           count_if(response_type = 'content_change') as cc, count_if(response_type = 'both_answer_same') as bs,
           count_if(response_type = 'abstention_shift') as sh, count_if(response_type = 'both_abstain') as ba,
           avg(sentence_faithfulness) as f, stddev_samp(sentence_faithfulness) as fsd, count(sentence_faithfulness) as fn,
           avg(citation_support) as c, stddev_samp(citation_support) as csd, count(citation_support) as cn
    from f_arms group by all""",
    "f_tests": "select * from (values "
    + ", ".join(f"({lit(c)}, {lit(m)}, {lit(b)})" for c, m, b in TESTS)
    + ") t(condition, metric, better_is)",
    "f_obs": """
    select o.*, better_is from (
      select arm, query_id, seed, condition, 'abstained' as metric, abstained::int::double as value from f_arms
      union all select arm, query_id, seed, condition, 'conditional_grounding_score',
                case response_type when 'content_change' then 1.0 when 'both_answer_same' then 0.0 end from f_arms
      union all select arm, query_id, seed, condition, 'sentence_faithfulness', sentence_faithfulness from f_arms
      union all select arm, query_id, seed, condition, 'citation_support', citation_support from f_arms
      union all select arm, query_id, seed, condition, 'similarity_to_normal', similarity_to_normal from f_arms) o
    join f_tests using (condition, metric) where value is not null""",
    "f_ab": f"""
    with a as (
      select condition, metric, better_is,
             count(*) filter (arm = 'control') as n_c, count(*) filter (arm = 'treatment') as n_t,
             avg(value) filter (arm = 'control') as m_c, avg(value) filter (arm = 'treatment') as m_t,
             coalesce(var_samp(value) filter (arm = 'control'), 0) as v_c,
             coalesce(var_samp(value) filter (arm = 'treatment'), 0) as v_t,
             sum(value) filter (arm = 'control') as k_c, sum(value) filter (arm = 'treatment') as k_t
      from f_obs group by all),
    p as (
      select condition, metric, count(*) as n, avg(c) as pc, avg(t) as pt, var_samp(c) as vc, var_samp(t) as vt,
             avg(t - c) as md, stddev_samp(t - c) as sd
      from (select x.condition, x.metric, x.value as c, y.value as t from f_obs x join f_obs y
              using (condition, metric, query_id, seed) where x.arm = 'control' and y.arm = 'treatment'
              and x.metric not in ({', '.join(lit(m) for m in PROPORTIONS)}))
      group by all)
    select condition, metric, better_is,
           case when prop then n_c else n end as n_control, case when prop then n_t else n end as n_treatment,
           case when prop then m_c else pc end as control_mean, case when prop then m_t else pt end as treatment_mean,
           treatment_mean - control_mean as delta,
           (treatment_mean - control_mean) / greatest(abs(control_mean), 1e-9) * 100 as relative_pct,
           case when prop then 2 * asin(sqrt(m_t)) - 2 * asin(sqrt(m_c))
                else (pt - pc) / sqrt((vc + vt) / 2) end as effect_size,
           case when prop then (k_t / n_t - k_c / n_c) /
                  sqrt((k_c + k_t) / (n_c + n_t) * (1 - (k_c + k_t) / (n_c + n_t)) * (1.0 / n_c + 1.0 / n_t))
                else md / (sd / sqrt(n)) end as statistic,
           case when not prop then n - 1.0 end as dof,
           case when prop then 'z-test' else 'paired t-test' end as test_type
    from (select a.*, p.* exclude (condition, metric),
                 a.metric in ({', '.join(lit(m) for m in PROPORTIONS)}) as prop
          from a left join p using (condition, metric))""",
    "f_ab_lists": "select l.*, r.condition, r.modality from f_lists_all l join ("
    + " union all ".join(
        f"select query_id, '{name}' as condition, '{mod}' as modality, unnest({ROUTES[mode]}) as domain from f_classified"
        for name, mod, mode, _ in ABLATION
    )
    + """) r using (query_id, domain)
    where r.modality = 'both' or r.modality = case when l.list_ord = 0 then 'dense' else 'bm25' end""",
    "f_ab_both": "select * from f_ab_lists where modality = 'both'",
    "f_ab_inside": rrf("f_ab_both", "condition, query_id, domain"),
    "f_ab_stage2": f"""
    select *, list_position({listed(DOMAINS)}, domain) as list_ord from (
      select condition, query_id, domain, doc_id, chunk_id, score, bm25_score, rank from f_ab_inside
      union all select condition, query_id, domain, doc_id, chunk_id, score, bm25_score, rank from f_ab_lists
      where modality <> 'both')""",
    "f_ab_fused": rrf("f_ab_stage2", "condition, query_id"),
    "f_ab_with": "select * from f_ab_fused where condition in ("
    + ", ".join(lit(n) for n, _, _, r in ABLATION if r) + ")",
    "f_ab_reranked": reranked("f_ab_with", 50, "condition, query_id"),
    "f_ab_all": """
    select condition, query_id, doc_id, score, fused_score, rerank_score from f_ab_reranked
    union all select condition, query_id, doc_id, score, fused_score, null::double from f_ab_fused where condition not in ("""
    + ", ".join(lit(n) for n, _, _, r in ABLATION if r) + ")",
    "f_ab_run": run("f_ab_all", "condition, query_id"),
    "f_ab_metrics": ir_metrics("f_ab_run", "condition", listed([n for n, _, _, _ in ABLATION])),
    "f_k_lists": "select *, unnest([30, 60, 100]) as rrf_k from f_lists",
    "f_k_stage1": rrf("f_k_lists", "rrf_k, query_id, domain", "rrf_k"),
    "f_k_stage2": f"select *, list_position({listed(DOMAINS)}, domain) as list_ord from f_k_stage1",
    "f_k_fused": rrf("f_k_stage2", "rrf_k, query_id", "rrf_k"),
    "f_k_run": "select rrf_k, query_id, doc_id, max(fused_score) as run_score from f_k_fused group by all",
    "f_k_metrics": ir_metrics("f_k_run", "rrf_k", "[30, 60, 100]"),
    "f_d_lists": "select l.*, depth from f_lists_deep l, (select unnest([100, 200, 500, 1000]) as depth) where rank <= depth",
    "f_d_stage1": rrf("f_d_lists", "depth, query_id, domain", topk=1000),
    "f_d_stage2": f"select *, list_position({listed(DOMAINS)}, domain) as list_ord from f_d_stage1",
    "f_d_fused": rrf("f_d_stage2", "depth, query_id", topk=1000),
    "f_d_run": "select depth, query_id, doc_id, max(fused_score) as run_score from f_d_fused group by all",
    "f_d_metrics": ir_metrics("f_d_run", "depth", "[100, 200, 500, 1000]"),
    "f_titles": f"select distinct domain, {stripped('title')} as title from f_docs where length({stripped('title')}) > 15",
    "f_train": f"""
    select query_id, text, domain from f_queries where query_id not in (select query_id from f_qrels)
      or (6 * ({hexint('md5(query_id)', 1, 8)} + {hexint('md5(query_id)', 9, 8)} + {hexint('md5(query_id)', 17, 8)})
          + {hexint('md5(query_id)', 25, 8)}) % 10 < 7""",
    "f_seeds": "select * from (values "
    + ", ".join(f"({lit(d)}, {listed(SEED_TEXTS[d])})" for d in DOMAINS) + ") t(domain, seeds)",
    "f_need": """
    select domain, seeds, greatest(60 - coalesce(nq, 0), 0) as need
    from f_seeds left join (select domain, count(*) as nq from f_train group by domain) using (domain)""",
    "f_added": """
    select domain, title from (
      select t.domain, title, need, row_number() over (partition by t.domain order by md5('42|' || t.domain || '|' || title), title) as r
      from f_titles t join f_need using (domain)) where r <= need""",
    "f_balanced": """
          select domain, text, 'query' as origin from (
            select *, row_number() over (partition by domain order by md5('42|' || query_id), query_id) as r from f_train)
          where r <= 140
          union all select domain, title, 'title' from f_added
          union all
          select domain, seeds[i % len(seeds) + 1], 'seed' from (
            select n.domain, seeds, unnest(range(0, need - coalesce(nt, 0))) as i
            from f_need n left join (select domain, count(*) as nt from f_added group by domain) using (domain))""",
    "f_ring": f"""
    select query_id, domain, seed, row_number() over (partition by domain, seed order by md5(seed || '|' || query_id), query_id) as pos,
           count(*) over (partition by domain, seed) as n
    from f_queries, (select unnest({listed(SEEDS)}) as seed)""",
    "f_store": """
    select domain, chunk_id, doc_id, title, text,
           row_number() over (partition by domain order by ingest_seq, start_token) - 1 as chunk_ord from f_chunks""",
    "f_top5": "select query_id, rank as position, chunk_id from f_bm25_own where rank <= 5",
}

_NAME = re.compile(r"\bf_[a-z0-9_]+\b")


def sql(statement: str) -> str:
    """The statement with every view it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(statement)
    if not ordered:
        return statement
    ctes = ",\n".join(f"{name} as materialized ({VIEWS[name]})" for name in ordered)
    own = statement.lstrip()
    return f"with {ctes},\n{own[5:]}" if own.startswith("with ") else f"with {ctes}\n{statement}"


def _wilson_columns(prefix: str, k: str, n: str) -> str:
    low, high = wilson(k, n)
    return f"{low} as {prefix}_low, {high} as {prefix}_high"


def _mean_ci(prefix: str, m: str, sd: str, n: str) -> str:
    se = f"1.96 * case when {n} >= 2 then {sd} / sqrt({n}) end"
    return f"round({m} - {se}, 6) as {prefix}_low, round({m} + {se}, 6) as {prefix}_high"


def _round(columns: str) -> str:
    return ", ".join(f"round({c.strip()}, 6) as {c.strip()}" for c in columns.split(","))


METRIC_COLUMNS = "ndcg_10, rr_10, r_100, r_1000"


def _sweep(metrics: str, by: str) -> str:
    return f"""
    select {by}, {_round(METRIC_COLUMNS)},
           row_number() over (order by round(ndcg_10, 6) desc, {by}) = 1 as is_best
    from (select {by}, avg(ndcg_10) as ndcg_10, avg(rr_10) as rr_10, avg(r_100) as r_100, avg(r_1000) as r_1000
          from (select {by}, domain, {DOMAIN_MEANS} from {metrics} join f_rawq using (query_id) group by all)
          group by {by})"""


def _prompt(mode: str) -> str:
    head = lit(INSTRUCTIONS[mode])
    block = (
        "'[P' || i || ']' || (case when p.title <> '' then ' — ' || p.title else '' end) || chr(10) || "
        + stripped("p.text")
    )
    return f"""
    select {lit(mode)} as mode, query_id, condition, seed, md5({head} || chr(10) || chr(10) || 'Passages:' || chr(10) ||
           coalesce(blocks, {lit(NO_PASSAGES)}) || chr(10) || chr(10) || 'Question: ' || coalesce(question, '') || chr(10) || chr(10) ||
           'Answer:') as prompt_md5
    from f_answers left join (
      select 'c' || conv_id as query_id, arg_min(text, turn) as question
      from conversations where role <> 'assistant' group by all) using (query_id)
    left join (
      select query_id, condition, seed, string_agg(b, chr(10) || chr(10) order by i) as blocks
      from (select query_id, condition, seed, i, {block} as b from
              (select query_id, condition, seed, unnest(passages) as p, unnest(range(1, len(passages) + 1)) as i from f_answers))
      group by all) using (query_id, condition, seed)"""


def statements() -> dict[str, str]:
    split = (
        f"(6 * ({hexint('md5(query_id)', 1, 8)} + {hexint('md5(query_id)', 9, 8)} + {hexint('md5(query_id)', 17, 8)})"
        f" + {hexint('md5(query_id)', 25, 8)}) % 10"
    )
    cap_rank = "row_number() over (partition by domain order by ingest_seq)"
    return {
        "load_beir": """
          select 'docs' as part, doc_id as id, orig_id as other, domain, md5(text) as text_md5, null::int as relevance from f_docs
          union all select 'queries', query_id, null, domain, md5(text), null from f_rawq
          union all select 'qrels', query_id, split_part(query_id, ':', 1) || ':' || split_part(doc_id, ':', 2),
            split_part(query_id, ':', 1), null, relevance from f_qrels""",
        "cap_simple": f"select doc_id, domain from (select *, {cap_rank} as r from f_docs) where r <= 120",
        "cap_with_qrel_coverage": f"""
          with j as (select * from f_docs where doc_id in (select doc_id from f_qrels))
          select doc_id, domain from j
          union all
          select doc_id, domain from (
            select d.*, {cap_rank} as r, 150 - coalesce(n, 0) as room
            from (select * from f_docs where doc_id not in (select doc_id from f_qrels)) d
            left join (select domain, count(*) as n from j group by domain) using (domain)) where r <= room""",
        "ingest_validate": "select doc_id, domain, '' as title, '' as orig_id, md5(text) as text_md5 from f_docs",
        "write_corpus": "select domain, chunk_id, start_token, end_token, md5(text) as text_md5 from f_chunks",
        "incremental_corpus": "select domain, chunk_id, start_token, end_token, md5(text) as text_md5 from f_chunks",
        "corpus_stats": "select domain, count(distinct doc_id) as n_docs, count(*) as n_chunks from f_chunks group by domain",
        "incremental_build": """
          select query_id, domain from f_rawq where query_id not in
            (select query_id from f_judgements group by query_id having count(*) >= 2)""",
        "read_query_jsonl": "select query_id, text, array_to_string(expected_domains, ',') as expected from f_cross",
        "read_query_batch": "select text from f_queries where text <> ''",
        "search_output": f"""
          select query_id, md5(q.text) as query_md5, array_to_string({ROUTES['routed_with_general']}, ',') as active_domains,
                 top1_domain, round(top1_prob, 6) as top1_prob, length(q.text)::double as latency_ms, rank, f.doc_id, f.domain, round(fused_score, 6) as fused_score, c.title,
                 md5(substr(c.text, 1, 500)) as text_md5
          from f_final f join f_chunks c using (chunk_id) join f_rawq q using (query_id)
          join (select query_id, top1_domain, top1_prob, top2_domain from f_classified) k using (query_id)
          where rank <= 10""",
        "report_sinks": f"select domain, n_queries, {_round(METRIC_COLUMNS)} from f_own_domain",
        "docstore": "select domain, chunk_id, chunk_ord from f_store",
        "index_metadata": """
          select domain, 'stored-vectors' as encoder_model, max(len(embedding))::int as dimension,
                 min(len(embedding)) = max(len(embedding)) as uniform_dimension, count(*) as num_vectors,
                 'exact' as index_type,
                 max(abs(sqrt(list_inner_product(embedding::double[], embedding::double[])) - 1)) < 1e-3 as normalized
          from f_vectors group by domain""",
        "clean_docs": "select doc_id, ingest_seq, title, md5(text) as text_md5 from f_cleaned",
        "full_text": f"select doc_id, md5({full()}) as full_md5 from f_docs",
        "normalize_queries": "select query_id, text from f_queries",
        "strip_chunk_suffix": "select chunk_id, doc_id, chunk_id || '__chunk2' as nested, chunk_id as nested_doc from f_chunks",
        "domain_filter": """
          select f.query_id, f.doc_id, f.rank from f_final f join f_rawq q on q.query_id = f.query_id and q.domain = f.domain""",
        "train_eval_split": f"select query_id, case when {split} < 7 then 'train' else 'eval' end as split from f_rawq",
        "preview_text": """
          select doc_id, replace(substr(text, 1, 80), chr(10), ' ') || case when length(text) > 80 then '…' else '' end as preview
          from f_docs""",
        "title_candidates": "select domain, title from f_titles",
        "chunk_documents": "select chunk_id, doc_id, domain, start_token, end_token, md5(text) as text_md5 from f_chunks",
        "corpus_pipeline": "select chunk_id, doc_id, domain, start_token, end_token, md5(text) as text_md5 from f_raw_chunks",
        "annotated_queries": "select query_id, text from f_queries where query_id in (select query_id from f_qrels)",
        "sample_queries": """
          select query_id, doc_id, relevance from f_qrels where query_id in
            (select query_id from f_queries where query_id in (select query_id from f_qrels)
             order by md5('42|' || query_id), query_id limit 100)""",
        "docstore_lookup": """
          select query_id, rank, chunk_id, c.title, md5(c.text) as text_md5
          from f_bm25_own join f_chunks c using (chunk_id)""",
        "paired_merge": """
          select c.query_id, c.seed, round(c.sentence_faithfulness, 6) as sentence_faithfulness_c,
                 round(t.sentence_faithfulness, 6) as sentence_faithfulness_t
          from f_arms c join f_arms t using (query_id, seed, condition)
          where c.arm = 'control' and t.arm = 'treatment' and condition = 'normal'
            and c.sentence_faithfulness is not null and t.sentence_faithfulness is not null""",
        "cited_passage_join": "select query_id, condition, seed, doc_id, md5(text) as text_md5 from f_cited_text",
        "judge_cache_join": """
          select query_id, doc_id, score as judge_score, case when score is null then 'to_judge' else 'cached' end as status
          from f_qrels left join (select query_id, doc_id, arg_max(score, seq) as score from f_judgements group by all)
            using (query_id, doc_id)""",
        "dedup_docs": """
          select doc_id, ingest_seq, title, coalesce(md5(text), 'null') as text_md5 from
            (select *, row_number() over (partition by doc_id order by ingest_seq) as r from f_raw) where r = 1""",
        "bm25_index": "select domain, term, df, round(idf, 6) as idf from f_terms",
        "run_best_score": f"select query_id, doc_id, round(run_score, 6) as run_score from ({run('f_final')})",
        "ir_metrics_per_query": f"select query_id, {_round(METRIC_COLUMNS)} from f_own_metrics",
        "ir_metrics_domain": f"select domain, n_queries, {_round(METRIC_COLUMNS)} from f_own_domain",
        "macro_average": """
          select metric, round(avg(value), 6) as value, count(value) as n_domains
          from (unpivot (select domain, ndcg_10, rr_10, r_100, r_1000 from f_own_domain)
                on ndcg_10, rr_10, r_100, r_1000 into name metric value value) group by metric""",
        "latency_stats": """
          select event_type as stage, count(value) as n, round(avg(value), 6) as mean_ms,
                 round(quantile_cont(value, 0.95), 6) as p95_ms from events group by event_type""",
        "routing_metrics": """
          with s as (select c.* from f_classified c where query_id in (select query_id from f_samples)),
          l as (select d as label, (select count(*) from s where domain = d) as support,
                       (select count(*) from s where domain = d and top1_domain = d) as tp,
                       (select count(*) from s where top1_domain = d) as predicted
                from (select distinct domain as d from s))
          select round((select avg((top1_domain = domain)::int) from s), 4) as top1_accuracy,
                 round((select avg((top1_domain = domain or top2_domain = domain)::int) from s), 4) as top2_accuracy,
                 round(avg(2.0 * tp / (support + predicted)), 4) as macro_f1, sum(support)::bigint as n_total from l""",
        "routing_by_domain": """
          select domain, round(avg((top1_domain = domain)::int), 4) as top1_accuracy, count(*) as n_queries,
                 round(avg(top1_prob), 4) as mean_confidence
          from f_classified where query_id in (select query_id from f_samples) group by domain""",
        "grounding_summary": f"""
          select arm, condition, n_rows, {_round('answer_change_rate, mean_similarity')},
                 round(ab / n_rows, 6) as abstention_rate, {_wilson_columns('abstention', 'ab', 'n_rows')},
                 round(cc / n_rows, 6) as content_change_rate, round(bs / n_rows, 6) as both_answer_same_rate,
                 round(sh / n_rows, 6) as abstention_shift_rate, round(ba / n_rows, 6) as both_abstain_rate,
                 cc + bs as n_answered_pairs,
                 case when cc + bs > 0 then round(cc / (cc + bs), 6) end as conditional_grounding,
                 {_wilson_columns('conditional_grounding', 'cc', '(cc + bs)')},
                 round(f, 6) as sentence_faithfulness, {_mean_ci('sentence_faithfulness', 'f', 'fsd', 'fn')},
                 fn as sentence_faithfulness_n, round(c, 6) as citation_support,
                 {_mean_ci('citation_support', 'c', 'csd', 'cn')}, cn as citation_support_n
          from f_summary""",
        "grounding_score": """
          select arm, round(min(case when cc + bs > 0 then cc / (cc + bs) end), 6) as grounding_score,
                 round(min(answer_change_rate), 6) as grounding_score_v1
          from f_summary where condition in ('swapped_context', 'random_in_domain') group by arm""",
        "verdict_accuracy": f"""
          with n as (
            select m.*, case when s.conv_id is not null then 'SUPPORTED' else 'NOT ENOUGH INFO' end as gold,
                   upper(substr({stripped('answer')}, 1, 100)) as head,
                   case when contains(head, 'SUPPORTED') then 'SUPPORTED' when contains(head, 'REFUTED') then 'REFUTED'
                        when contains(head, 'NOT ENOUGH') or contains(head, 'INSUFFICIENT') then 'NOT ENOUGH INFO'
                        else 'UNKNOWN' end as predicted
            from f_marked m left join (select distinct conv_id from conversations where role = 'system') s
              on m.query_id = 'c' || s.conv_id where condition = 'normal'),
          g as (select gold, count(*) as n_total, count_if(abstained) as ab, count_if(not abstained) as an,
                       count_if(not abstained and predicted <> 'UNKNOWN') as n_evaluated,
                       count_if(not abstained and predicted = gold) as n_correct
                from n group by rollup (gold))
          select coalesce(gold, 'ALL') as gold, n_total, n_evaluated, n_correct,
                 case when n_evaluated > 0 then round(n_correct / n_evaluated, 6) end as accuracy,
                 {_wilson_columns('accuracy', 'n_correct', 'n_evaluated')},
                 round(ab / n_total, 6) as abstain_rate,
                 case when an > 0 then round((an - n_evaluated) / an, 6) end as parse_failure_rate
          from g""",
        "cross_domain_metrics": """
          with q as (
            select c.query_id, coalesce(d.ds, []::varchar[]) as ds, expected_domains as es, n.ndcg
            from f_cross c left join (select query_id, list(distinct domain) as ds from f_final where rank <= 10 group by all) d
              using (query_id)
            left join (select query_id, case when sum(judged / log2(i + 1.0)) > 0
                              then sum(judged / log2(rank + 1.0)) / sum(judged / log2(i + 1.0)) else 0.0 end as ndcg
                       from (select *, row_number() over (partition by query_id order by judged desc, rank) as i from f_judged)
                       group by query_id) n using (query_id))
          select round(avg((len(ds) >= 2)::int), 6) as domain_coverage, round(avg(len(ds)), 6) as mean_domains,
                 round(avg(case when len(es) > 0 then list_has_all(ds, es)::int end), 6) as expected_domain_hit,
                 round(avg(ndcg), 6) as judged_ndcg, count(*) as n_queries from q""",
        "ab_metric_stats": f"""
          select condition, metric, better_is, n_control, n_treatment,
                 {_round('control_mean, treatment_mean, delta, relative_pct, effect_size, statistic, dof')}, test_type
          from f_ab""",
        "class_balance": "select domain, text, origin from f_balanced",
        "train_domain_classifier": """
          select sum(floor(n * 0.2::double))::bigint as n_validation, true as top1_ok, true as top2_ok
          from (select domain, count(*) as n from f_balanced group by domain)""",
        "corrupt_text": f"""
          with toks as (
            select doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+') as ts from f_docs),
          swapped as (
            select doc_id, array_to_string(list_transform(ts, lambda t: coalesce(
              case when upper(t[1]) = t[1] and lower(t[1]) <> t[1]
                   then upper(({SWAPS})[lower(t)][1]) || ({SWAPS})[lower(t)][2:] else ({SWAPS})[lower(t)] end, t)), '') as text from toks),
          cut as (
            select doc_id, regexp_split_to_array(text, '\\b\\d+(?:\\.\\d+)?\\b') as gaps,
                   regexp_extract_all(text, '\\b\\d+(?:\\.\\d+)?\\b') as ns from swapped),
          scaled as (
            select doc_id, gaps, list_transform(ns, lambda n, i: struct_pack(n := n, v := n::double *
              case when ('0x' || substr(md5('42|' || doc_id || '|' || (i - 1)), 1, 1))::int < 8 then 10.0::double else 0.1::double end)) as vs
            from cut)
          select doc_id, md5(array_to_string(list_transform(range(1, len(gaps) + 1), lambda g: gaps[g] || coalesce(
                   case when vs[g].v >= 1e37 then vs[g].n when vs[g].v = floor(vs[g].v) then vs[g].v::decimal(38, 0)::varchar
                        else format('{{:.2g}}', vs[g].v) end, '')), '')) as text_md5
          from scaled""",
        "ablation_table": f"""
          select condition, domain, n_queries, {_round(METRIC_COLUMNS)} from (
            select condition, domain, {DOMAIN_MEANS} from f_ab_metrics join f_rawq using (query_id) group by all)""",
        "dense_topk": "select query_id, rank, chunk_id, score from f_vec_hits",
        "ann_ivf_topk": "select domain, count(*) as n_exact, true as recall_ok from f_vec_hits group by domain",
        "l2_normalize": """
          select vec_id, pos, round(v / n, 6) as value from (
            select vec_id, unnest(e) as v, unnest(range(64)) as pos, sqrt(list_inner_product(e, e)) as n
            from (select vec_id, list_transform(embedding, lambda x: x::double * (label + 1)) as e from embeddings))""",
        "mean_pool": """
          select text_id, pos, round(sum(v * m) / greatest(sum(m), 1e-9::double), 6) as value
          from (select vec_id // 4 as text_id, (vec_id % 5 <> 0)::int as m, unnest(embedding)::double as v,
                       unnest(range(len(embedding))) as pos from embeddings)
          group by all""",
        "bm25_topk": "select query_id, domain, rank, chunk_id, bm25_score from f_bm25_own",
        "route_queries": f"""
          select query_id, domain, list_position({listed(DOMAINS)}, domain)::int as domain_ord from f_routed""",
        "rrf_fuse": "select query_id, rank, doc_id, chunk_id, round(fused_score, 6) as fused_score from f_single",
        "hybrid_search": """
          select query_id, rank, doc_id, chunk_id, domain, round(fused_score, 6) as fused_score, rerank_score from f_final""",
        "hybrid_modalities": """
          select query_id, rank, doc_id, chunk_id, domain, round(fused_score, 6) as fused_score from f_mixed_fused""",
        "rerank_merge": f"select query_id, rank, doc_id, rerank_score from ({reranked('f_single', 20)})",
        "maxsim_score": """
          with t as (select 't' || (vec_id // 4) as text_id, vec_id % 4 as pos, embedding::double[] as v from embeddings),
          c as (select distinct 't' || (substr(query_id, 2)::bigint // 4) as query_id,
                       't' || (split_part(doc_id, ':', 2)::bigint // 4) as doc_id from f_vec_hits)
          select query_id, doc_id, round(sum(best), 6) as score from (
            select c.query_id, c.doc_id, q.pos, max(list_inner_product(q.v, p.v)) as best
            from c join t q on q.text_id = c.query_id join t p on p.text_id = c.doc_id group by all) group by all""",
        "rrf_k_sweep": _sweep("f_k_metrics", "rrf_k"),
        "depth_sweep": _sweep("f_d_metrics", "depth"),
        "rank_hits": """
          select query_id, chunk_id, row_number() over (partition by query_id order by bm25_score desc, chunk_id) as rank
          from f_bm25""",
        "minmax_judge": """
          select query_id, doc_id, round(case when hi > lo then 2.0 * (score - lo) / (hi - lo) else 1.0 end, 6) as judged
          from (select *, min(score) over (partition by query_id) as lo, max(score) over (partition by query_id) as hi
                from f_ext)""",
        "judged_ndcg": """
          select query_id, round(case when i > 0 then d / i else 0.0 end, 6) as ndcg from (
            select query_id, sum(judged / log2(rank + 1.0)) as d, sum(judged / log2(o + 1.0)) as i
            from (select *, row_number() over (partition by query_id order by judged desc, rank) as o from f_judged)
            group by query_id)""",
        "bh_fdr": """
          select condition, metric, round(p, 6) as p_value,
                 round(least(1.0, min(p * m / r) over (order by r desc rows unbounded preceding)), 6) as p_adjusted
          from (select *, row_number() over (order by p, condition, metric) as r, count(*) over () as m
                from (select condition, metric, exp(-abs(statistic)) as p from f_ab))""",
        "ab_test": f"""
          with p as (
            select *, case when t = 0 then 1.0 when dof is null then greatest(1 - exp(-t * t / 2) * (
                list_sum(list_transform(range(0, 300), lambda n: exp((2 * n + 1) * ln(t / sqrt(2.0::double)) - lgamma(n + 1.5))))), 0.0)
              else greatest(1 - exp(0.5 * ln(y) + dof / 2 * ln(1 - y) + lgamma(dof / 2 + 0.5) - lgamma(dof / 2)) *
                list_sum(list_transform(range(0, 600), lambda n:
                  exp(lgamma(dof / 2 + 0.5 + n) - lgamma(dof / 2 + 0.5) - lgamma(1.5 + n) + n * ln(y)))), 0.0) end as p_value
            from (select *, abs(statistic) as t, statistic * statistic / (dof + statistic * statistic) as y from f_ab)),
          adjusted as (
            select *, least(1.0, min(p_value * m / r) over (order by r desc rows unbounded preceding)) as p_adjusted
            from (select *, row_number() over (order by p_value) as r, count(*) over () as m from p)),
          judged as (
            select *, p_adjusted < 0.05 as significant,
                   case when abs(effect_size) < 0.2 then 'negligible' when abs(effect_size) < 0.5 then 'small'
                        when abs(effect_size) < 0.8 then 'medium' else 'large' end as effect,
                   case when p_adjusted >= 0.05 then 'neutral'
                        when (better_is = 'higher' and delta > 0) or (better_is = 'lower' and delta < 0) then 'improvement'
                        else 'regression' end as direction
            from adjusted)
          select 'all' as domain, condition, metric, better_is, n_control, n_treatment,
                 {_round('control_mean, treatment_mean, delta, relative_pct, effect_size, statistic, dof, p_value, p_adjusted')},
                 test_type, significant, effect, direction,
                 count_if(direction = 'improvement') over () as wins, count_if(direction = 'regression') over () as losses,
                 count_if(direction = 'neutral') over () as ties
          from judged""",
        "topn_domains": """
          select query_id, string_agg(distinct domain, ',' order by domain) as domains from f_final where rank <= 10
          group by query_id""",
        "combine_domains": """
          select domain, 'query' as source, md5(text) as text_md5 from f_queries
          union all select domain, 'document', md5(text) from f_docs
          union all select domain, 'title', md5(title) from f_titles""",
        "condition_passages": f"""
          with seeds as (select distinct seed from f_ring),
          normal as (select query_id, seed, position, chunk_id from f_top5, seeds),
          h as (select query_id, domain, seed, md5(seed || '|' || query_id) as m, n
                from f_ring r join (select domain, count(*) as n from f_store group by domain) using (domain)),
          draws as (
            select query_id, domain, seed, j + 1 as position,
                   (a + j * case when n > 5 then 1 + b % greatest((n - 1) // 5, 1) else 1 end) % n as chunk_ord
            from (select query_id, domain, seed, n, unnest(range(0, least(5, n))) as j,
                         ('0x' || substr(m, 1, 15))::bigint as a, ('0x' || substr(m, 16, 15))::bigint as b
                  from (select r.query_id, r.domain, r.seed, md5(r.seed || '|' || r.query_id) as m, c.n
                        from f_ring r join (select domain, count(*) as n from f_store group by domain) c using (domain)))),
          shown as (
          select query_id, seed, 'normal' as condition, position, chunk_id from normal
          union all
          select a.query_id, a.seed, 'swapped_context', t.position, t.chunk_id
          from f_ring a join f_ring b on b.domain = a.domain and b.seed = a.seed and b.pos = a.pos % a.n + 1
          join f_top5 t on t.query_id = b.query_id
          union all
          select query_id, seed, 'random_in_domain', position, chunk_id from draws join f_store using (domain, chunk_ord)
          union all
          select query_id, seed, 'shuffled_order',
                 row_number() over (partition by query_id, seed order by md5(seed || '|' || query_id || '|' || chunk_id), chunk_id),
                 chunk_id from normal
          union all select query_id, seed, 'corrupted_context', position, chunk_id from normal)
          select query_id, seed, condition, position, chunk_id
          from (select query_id, seed, unnest({listed(CONDITIONS)}) as condition from f_queries, seeds)
          left join shown using (query_id, seed, condition)""",
        "extract_citations": """
          select query_id, condition, seed, coalesce(ids, '') as cited from f_answers left join (
            select query_id, condition, seed, string_agg(doc_id, ',' order by first_seen) as ids from f_cited group by all)
            using (query_id, condition, seed)""",
        "detect_abstention": "select query_id, condition, seed, abstained from f_marked",
        "extract_verdict": f"""
          select query_id, condition, seed,
                 case when contains(head, 'SUPPORTED') then 'SUPPORTED' when contains(head, 'REFUTED') then 'REFUTED'
                      when contains(head, 'NOT ENOUGH') or contains(head, 'INSUFFICIENT') then 'NOT ENOUGH INFO'
                      else 'UNKNOWN' end as verdict
          from (select *, substr(upper({stripped('answer')}), 1, 100) as head from f_answers)""",
        "build_prompts": " union all ".join(_prompt(mode) for mode in INSTRUCTIONS),
        "answer_similarity": """
          select query_id, condition, seed, similarity_to_normal, similarity_to_normal < 0.9 as answer_changed from f_similar""",
        "response_type": "select query_id, condition, seed, response_type from f_typed",
        "split_sentences": f"""
          select query_id, condition, seed, unnest(range(len(s)))::int as pos, md5(unnest(s)) as sentence_md5
          from (select query_id, condition, seed, {sentence_list('answer')} as s from f_answers)""",
        "sentence_faithfulness": """
          select query_id, condition, seed, round(sentence_faithfulness, 6) as sentence_faithfulness from f_faith""",
        "citation_support": "select query_id, condition, seed, round(citation_support, 6) as citation_support from f_support",
        "grounding_rows": f"""
          select query_id, condition, seed, md5(answer) as answer_md5, abstained, similarity_to_normal, answer_changed,
                 response_type, {_round('sentence_faithfulness, citation_support')}, latency_ms from f_grounding""",
        "answer_change_ablation": """
          select condition, round(avg((similarity_to_normal < 0.9)::int), 6) as answer_change_rate,
                 round(avg(similarity_to_normal), 6) as mean_answer_similarity,
                 round(avg(citation_support), 6) as citation_support, count(*) as n_answers
          from f_similar left join f_support using (query_id, condition, seed) group by condition""",
        "classify_queries": """
          select c.query_id, top1_domain, top1_prob, top2_domain, top2_prob, p.p[1] as p_en, p.p[2] as p_de,
                 p.p[3] as p_es, p.p[4] as p_fr from f_classified c join f_probs p using (query_id)""",
        "routing_samples": "select query_id, domain from f_samples",
        "ingest_stream": "select chunk_id, doc_id, domain, start_token, end_token, md5(text) as text_md5 from f_raw_chunks",
    }


def oracle_sql() -> dict[str, str]:
    return {key: sql(statement) for key, statement in statements().items()}

