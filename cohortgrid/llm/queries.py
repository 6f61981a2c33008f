"""Registered queries of the text-corpus operators.

Each takes (spark, sf_dir) and applies one operator with production
parameters to its whole table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgrid.llm import toxicity
from cohortgrid.llm.embedding_dedup import embedding_dedup
from cohortgrid.llm.exact_dedup import exact_dedup
from cohortgrid.llm.lexical_search import lexical_search
from cohortgrid.llm.ngram_join import ngram_jaccard_join
from cohortgrid.llm.phrase_mining import phrase_mining
from cohortgrid.llm.quality_classifier import score, train
from cohortgrid.llm.quality_rules import quality_rules
from cohortgrid.llm.secret_scan import secret_scan
from cohortgrid.llm.sentencepiece_viterbi import encode
from cohortgrid.llm.source_mix import mix_sources, source_sizes
from cohortgrid.llm.storage import table, workspace
from cohortgrid.llm.token_counts import token_counts
from cohortgrid.llm.token_files import read_token_files, write_token_files


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{workspace(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return read_token_files(spark, path)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), check=True)
    return coded.select("doc_id", "ids", F.size("ids").alias("n_tokens"), "round_trip")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is an owner; its documents of one language a repository."""
    return secret_scan(table(spark, sf_dir, "documents"), owner=F.col("source"), repository=F.col("lang"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights are the square roots of the sources' sizes."""
    docs = table(spark, sf_dir, "documents")
    return mix_sources(docs, source_sizes(docs).select("source", F.sqrt("size").alias("weight")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    model = toxicity.train(docs, labels, lambda id_: F.pmod(F.crc32(id_.cast("string")), F.lit(3)) != 1)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is a host."""
    return quality_rules(table(spark, sf_dir, "documents"), host=F.col("source")).drop("host_rate")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_ngram_join": op3_ngram_join,
        "op4_embedding_dedup": op4_embedding_dedup,
        "op5_secret_scan": op5_secret_scan,
        "op6_source_mix": op6_source_mix,
        "op7_toxicity": op7_toxicity,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_token_counts": op10_token_counts,
        "op11_lexical_search": op11_lexical_search,
        "op12_phrase_mining": op12_phrase_mining,
        "op13_quality_rules": op13_quality_rules,
    }


_SECRETS = r"""
    with kinds(kind, name, pattern, least) as (values
        (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 12),
        (1, 'access', 'AKIA[A-Z0-9]+', 18), (2, 'hex', '[0-9a-f]{16,}', 16), (3, 'mixed', '[A-Za-z0-9+/_-]{24,}', 24)),
    found as (
        select doc_id, source, lang, kind, name, least, regexp_extract_all(coalesce(text, ''), pattern) as ms, regexp_split_to_array(coalesce(text, ''), pattern) as gaps
        from documents, kinds),
    cut as (select *, unnest(range(1, len(ms) + 1)) as i from found where len(ms) > 0),
    spans as (
        select doc_id, source, lang, kind, name, least, ms[i] as m,
               list_sum(list_transform(gaps[1:i], lambda x: length(x)))::bigint + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)::bigint as s
        from cut),
    valued as (
        select *, s + length(m) as e,
               case when kind = 0 then regexp_extract(m, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) else m end as v
        from spans),
    kept as (
        select * from valued where length(v) >= least
        and (kind < 3 or (regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]') and regexp_matches(v, '[0-9]')))),
    owners as (
        select v, count(distinct coalesce(source, chr(1))) as n_owners, count(distinct (coalesce(source, chr(1)), coalesce(lang, chr(1)))) as n_repositories
        from kept group by v),
    judged as (select k.*, n_owners <= 1 and n_repositories <= 2 as live, n_owners <= 1 and n_repositories > 2 as spread from kept k join owners using (v)),
    listed as (
        select * from judged j where kind < 3
        union all
        select * from judged j where kind = 3 and live and not exists (
            select 1 from judged b where b.doc_id = j.doc_id and b.kind < 3 and b.s < j.e and j.s < b.e)),
    per_doc as (
        select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
               string_agg(name || ':' || s || ':' || e, ',' order by s, kind) filter (kind < 3) as base,
               string_agg(name || ':' || s || ':' || e, ',' order by s, kind) as spans,
               count(*) filter (live) as n_live, count(*) filter (not live) as n_copied, count(*) filter (spread) as n_spread
        from listed group by doc_id)
    select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
           sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
           coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied, coalesce(n_spread, 0) as n_spread
    from documents left join per_doc using (doc_id)"""

_SEARCH = r"""
    with held as (
        select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts
        from documents),
    totals as (select count(*) filter (len(ts) > 0) as big_n, sum(len(ts))::hugeint as big_l from held),
    normed as (select doc_id, ts, (75 + (25::hugeint * len(ts) * big_n) // big_l)::bigint as m from held, totals where len(ts) > 0),
    asked as (
        select row_number() over (order by item_id, text) as q, item_id,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts
        from benchmark),
    words as (select q, item_id, unnest(ts) as t from asked),
    times as (select q, item_id, t, count(*) as times from words group by all),
    rows_ as (select u, doc_id, m, ts from (select row_number() over () as u, * from normed)),
    spread as (select u, doc_id, m, unnest(ts) as t from rows_),
    counted as (select u, doc_id, m, t, count(*) as tf from spread where t in (select t from times) group by all),
    weights as (select t, floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double))::bigint as w from counted, totals group by t, big_n),
    scored as (
        select q, item_id, u, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
        from counted join weights using (t) join times using (t) group by all),
    ranked as (select *, row_number() over (partition by q order by score desc, doc_id nulls last) as rank from scored where score > 0)
    select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20"""

_PHRASES = r"""
    with pieces as (
        select row_number() over () as p, lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws
        from (select coalesce(lang, 'und') as lang,
                     unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
              from documents)),
    sizes as (select lang, sum(len(ws))::bigint as n from pieces group by lang),
    starts as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from pieces),
    grams as (select lang, ws[i : i + k - 1] as g, k from starts, range(1, 5) as t(k) where i + k - 1 <= len(ws)),
    f as (select lang, g, k, count(*) as f from grams group by all having count(*) >= 30),
    subsumed as (
        select lang, g, max(f) as most from (select lang, f, unnest([g[1 : k - 1], g[2 : k]]) as g from f where k > 2) group by all),
    wide as (
        select lang, ip as g, max(f) as most
        from (select lang, f, unnest([g[1 : 2], g[2 : 3], g[3 : 4]]) as ip from f where k = 4) group by all),
    left_ as (
        select f.* from f left join subsumed s using (lang, g) left join wide v using (lang, g)
        where k > 1 and 100::hugeint * greatest(coalesce(s.most, 0), coalesce(v.most, 0)) < 80::hugeint * f.f),
    cuts as (select lang, g, f as a, unnest(range(1, k)) as c, k from left_),
    scored as (
        select cuts.lang, cuts.g, a, c, x.f as l, y.f as r, ((2000000::hugeint * a) // (x.f::hugeint + y.f))::bigint as score
        from cuts join f x on x.lang = cuts.lang and x.g = cuts.g[1 : c] join f y on y.lang = cuts.lang and y.g = cuts.g[c + 1 : cuts.k]),
    best as (select * from scored qualify row_number() over (partition by lang, g order by score, c) = 1),
    ranked as (
        select lang, row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) as rank,
               array_to_string(g, ' ') as phrase, a, l, r, score
        from best)
    select lang, rank, phrase, a, l, r, n, score from ranked join sizes using (lang) where rank <= 2000"""

_RULES = r"""
    with d as (select row_number() over () as u, doc_id, source, coalesce(text, '') as t from documents),
    split as (
        select u, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
        from d),
    starts as (select u, ws, unnest(range(1, len(ws) - 6)) as i from split where len(ws) >= 8),
    windows as (select u, i, array_to_string(ws[i : i + 7], ' ') as w from starts),
    again as (select u, i from windows qualify count(*) over (partition by u, w) > 1),
    hit as (select u, count(distinct j) as n_repeat_words from (select u, unnest(range(i, i + 8)) as j from again) group by u),
    measures as (
        select u, doc_id, source, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(ls) as n_lines,
               (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
        from split left join hit using (u)),
    failed as (
        select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
               [(10 * n_symbols > n_words)::int, (100 * n_dup_lines > 30 * n_lines)::int,
                (n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words))::int] as fs
        from measures),
    hosts as (
        select source, rule, count(*)::double as n, sum(fs[rule])::double as bad
        from failed, range(1, 4) as r(rule) group by all),
    moments as (
        select rule, sum(bad) / sum(n) as mean, sum(bad * bad / n) - sum(bad) / sum(n) * sum(bad) as spread,
               count(*)::double as h, sum(n) as n, sum(n * n) as n2 from hosts group by rule),
    priors as (
        select rule, mean, case when excess > 0 then greatest(least(1 / excess - 1, 1e6), 10) else 1e6 end as weight
        from (select *, case when below != 0 then (spread - mean * (1 - mean) * (h - 1)) / below end as excess
              from (select *, mean * (1 - mean) * (n - n2 / n - (h - 1)) as below from moments))),
    verdicts as (
        select source, max(round((bad + mean * weight) / (n + weight), 9)) >= 0.5 as host_rejected
        from hosts join priors using (rule) group by source)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not host_rejected as kept, host_rejected
    from failed f join verdicts v on f.source is not distinct from v.source"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_lexical_search": _SEARCH,
        "op12_phrase_mining": _PHRASES,
        "op13_quality_rules": _RULES,
        "op5_secret_scan": _SECRETS,
        "op6_source_mix": r"""
            with sizes as (select source, sum(length(coalesce(text, '')))::double as size from documents group by source),
            rates as (select source, case when size > 0 then sqrt(size) / sum(sqrt(size)) over () * sum(size) over () / size else 1.0 end as rate from sizes),
            terms as (select source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::bigint + 1)) as k from rates),
            cdf as (select source, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by source order by k) as c from terms),
            drawn as (select *, ('0x' || substr(md5('0:' || doc_id || ':' || md5(coalesce(text, ''))), 1, 13))::bigint / 4503599627370496.0 as u from documents),
            counts as (select doc_id, count(*) as n from drawn join cdf on drawn.source is not distinct from cdf.source and c <= u group by doc_id)
            select d.*, unnest(range(1, n + 1)) as mix_copy from documents d join counts using (doc_id)""",
        "op8_exact_dedup": r"""
            with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
            select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
                   doc_id = min(doc_id) over w as kept, sha256(t) as text_sha256
            from d window w as (partition by t)""",
    }
