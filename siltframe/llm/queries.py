"""The registered queries of the thirteen operators and of the pipeline, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import brown, collocations, decontam, divergence, exact, langid, licenses, minhash, packing, pagetext, toxicity, urls, wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    from public_tokenizers import path

    return path(name)


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op2_pagetext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extracted(_table(spark, sf_dir, "pages"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(_table(spark, sf_dir, "documents"))

_TEMPLATE_ROWS = ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(licenses.TEMPLATES))
_WORDS = "list_distinct(regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{1}'))"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLES["op4_licenses"] = rf"""
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
  w as (select doc_id, regexp_extract_all(t, '{_WORD}') as words from d),
  placed as (select doc_id, unnest(words) as word, unnest(range(len(words))) as pos from w),
  runs as (select *, lead(word) over (partition by doc_id order by pos) as second, lead(word, 2) over (partition by doc_id order by pos) as third from placed),
  base as (select doc_id, pos, case when word = 'cc' and second = 'by' then 'cc-by' when word = 'general' and second = 'public' and third = 'license' then 'gpl'
      when word = 'all' and second = 'rights' and third = 'reserved' then 'reserved' end as label from runs),
  found as (select doc_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word from base where label is not null group by doc_id),
  b as (select doc_id, unnest(string_split_regex(regexp_replace(t, '([.!?])[ \t\r\n]+', '\1' || chr(10) || chr(10), 'g'), '\n[ \t\r]*\n')) as block from d),
  numbered as (select doc_id, row_number() over () as block_no, {_WORDS.format("block", _WORD)} as own from b),
  t as (select label, {_WORDS.format("text", _WORD)} as tokens from (values {_TEMPLATE_ROWS}) v(k, label, text)),
  hit as (select doc_id, block_no, label, list_intersect(own, tokens) as held, len(list_intersect(own, tokens)) / len(tokens) as share from numbered, t
    where len(own) >= 4 and len(list_intersect(own, tokens)) >= ceil(0.8 * len(tokens))),
  best as (select * from hit x where not exists (select 1 from hit y where y.block_no = x.block_no
    and (y.share > x.share or y.share = x.share and len(y.held) > len(x.held)) and len(list_intersect(x.held, y.held)) = len(x.held))),
  named as (select doc_id, label, 1 as base from base where label is not null union select doc_id, label, 0 from best),
  labels as (select doc_id, string_agg(distinct label, ',' order by label) as labels, string_agg(distinct label, ',' order by label) filter (base = 1) as base_labels from named group by doc_id),
  shares as (select doc_id, max(share) as share from best group by doc_id)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels,
  coalesce(labels, '') as labels, case when n_base > 0 then 1.0::double else coalesce(share, 0)::double end as score
from w left join found using (doc_id) left join labels using (doc_id) left join shares using (doc_id)
"""


ORACLES["op5_exact"] = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n
"""


@query
def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op7_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scores(_table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: Host, path and verdict of the address rules.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

ORACLES["op9_urls"] = r"""
with recursive rules(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
  tags as (select url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) as tag from pages where url is not null and html is not null),
  links as (select url, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) as dst from tags where regexp_matches(tag, '(?is)\brel\s*=\s*["'']?\s*canonical\b')
    union all select url, regexp_extract(tag, '(?is)\burl\s*=\s*["'']?\s*([^"''>;\s]+)', 1) from tags where regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
  edges as (select trim(regexp_replace(url, '(?s)#.*$', '')) as a, trim(regexp_replace(dst, '(?s)#.*$', '')) as b from links where dst like '%://%'),
  nodes as (select a as url from edges union select b from edges union select trim(regexp_replace(url, '(?s)#.*$', '')) from pages where url is not null),
  parts as (select url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from nodes),
  ruled as (select parts.*, h || p as rule, v from parts left join rules on (host = h or host like '%.' || h) and starts_with(path, p)
    qualify row_number() over (partition by url order by length(h || p) desc) = 1),
  reach(a, b) as (select a, b from edges union select b, a from edges union select r.a, e.b from reach r join (select a, b from edges union select b, a from edges) e on r.b = e.a),
  seen as (select url, v from ruled where v is not null union all select r.a, u.v from reach r join ruled u on r.b = u.url where u.v is not null),
  method as (select url, case when bool_or(v = 'allow') then 'allow' when bool_or(v = 'block') then 'block' else 'allow' end as verdict from seen group by url)
select page_id, coalesce(ruled.host, '') as host, coalesce(ruled.path, '') as path, rule, coalesce(v, method.verdict, 'allow') as verdict
from pages left join ruled on ruled.url = trim(regexp_replace(pages.url, '(?s)#.*$', '')) left join method on method.url = ruled.url
"""


@query
def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return urls.judged(pages, URL_RULES, urls.page_links(pages))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(_table(spark, sf_dir, "documents"))


ORACLES["op11_divergence"] = r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words from documents),
  w as (select r, lang, source, unnest(words) as term from d),
  c as (select lang, source, term, count(*) as n, count(distinct r) as docs from w group by all),
  kept as (select lang, term, sum(n) as n from c group by all having sum(docs) >= 30),
  v as (select lang, count(*) as v, sum(n) as n from kept group by lang),
  g as (select distinct lang, source from d),
  cells as (select lang, source, term, coalesce(c.n, 0) as n, kept.n as in_lang from g join kept using (lang) left join c using (lang, source, term)),
  totals as (select lang, source, sum(n) as total from cells group by all),
  priced as (select lang, source, term, cells.n, 1 + (1000000000::hugeint * (cells.n + 5)) // (total + 5 * v) as p,
    1 + (1000000000::hugeint * (in_lang + 5)) // (v.n + 5 * v) as q from cells join totals using (lang, source) join v using (lang)),
  pairs as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from priced a join priced b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
  pair as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value from g a join g b on a.lang = b.lang and a.source <> b.source
    left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source),
  term as (select lang, source, 'term' as part, term as item, cast(p - q as bigint) as value from priced where n > 0 and p > q),
  ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from (select * from pair union all select * from term))
select * from ranked where part = 'pair' or rank <= 50
"""


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"))


_GRAMS = " union all ".join(f"select lang, {k} as k, unnest([words[i:i + {k - 1}] for i in range(1, len(words) - {k - 2})]) as words from p" for k in range(1, 6))
ORACLES["op12_collocations"] = rf"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
  s as (select lang, unnest(string_split(regexp_replace(t, '[.,;:!?\x0A-\x0D]', chr(10), 'g'), chr(10))) as piece from d),
  p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from s),
  f as (select lang, k, array_to_string(words, ' ') as phrase, any_value(words) as words, count(*) as f from ({_GRAMS}) group by lang, k, phrase),
  totals as (select lang, sum(f) as n from f where k = 1 group by lang),
  a as (select * from f where k >= 2 and f >= 100),
  cuts as (select lang, phrase, f, words, k, unnest(range(1, k)) as j from a),
  parts as (select cuts.lang, cuts.phrase, cuts.f as a, j, l.f as l, r.f as r, cast(n as bigint) as n, cast((1000::hugeint * cuts.f * n) // (l.f::hugeint * r.f) as bigint) as score
    from cuts join totals using (lang) join f l on l.lang = cuts.lang and l.k = j and l.phrase = array_to_string(cuts.words[1:j], ' ')
    join f r on r.lang = cuts.lang and r.k = cuts.k - j and r.phrase = array_to_string(cuts.words[j + 1:], ' ')),
  best as (select * from parts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
  held as (select distinct x.lang, x.phrase from a x join a y on x.lang = y.lang and y.k > x.k and 100 * y.f >= 100 * x.f and contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')),
  ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best anti join held using (lang, phrase))
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


@query
def op13_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
