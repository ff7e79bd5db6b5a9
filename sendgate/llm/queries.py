"""One query per operator over its whole table, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sendgate.llm import url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# 1 URL filters ------------------------------------------------------------------------

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@_query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).drop("url")


ORACLES["op1_url_filter"] = """
with rules(rule_host, rule_path, rule_verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
           ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), rests as (
    select page_id, url,
           case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages
), parts as (
    select page_id, url, regexp_extract(coalesce(rest, ''), '^[^/?#]*') as raw_host,
           regexp_extract(coalesce(rest, ''), '^[^?#]*') as both_parts
    from rests
), hosts as (
    select page_id, url, substr(both_parts, length(raw_host) + 1) as path,
           translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host
    from parts
), ranked as (
    select page_id, host, path, rule_host || rule_path as rule, rule_verdict,
           row_number() over (partition by page_id, url
                              order by length(rule_host) + length(rule_path) desc) as place
    from hosts left join rules
        on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
from ranked where place = 1
"""

# 5 Byte-level BPE ---------------------------------------------------------------------


def public_vocabulary():
    import public_tokenizers

    from sendgate.llm import bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.Vocabulary.read(path, public_tokenizers.PATTERN)


@_query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import bpe

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(documents, public_vocabulary())


# 10 Sharding --------------------------------------------------------------------------


@_query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import sharding

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_documents(documents, shards=24)

# 7 Toxicity ---------------------------------------------------------------------------


def held_out(doc_id):
    """Rows that no label is learned from: crc32 of the id's text is divisible by 5."""
    return F.crc32(F.to_binary(doc_id.cast("string"), F.lit("utf-8"))) % 5 == 0


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import toxicity

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    known = labels.where(~held_out(F.col("doc_id")))
    model = toxicity.fit(documents, known)
    scored = toxicity.score_texts(documents, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

# 4 HTML extraction --------------------------------------------------------------------


@_query
def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import html_extract

    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extract.extract_text(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

# 9 Embedding near-dedup ---------------------------------------------------------------


@_query
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import embedding_dedup

    embeddings = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embedding_dedup.near_duplicates(embeddings)

# 2 Approximate nearest neighbours -----------------------------------------------------


@_query
def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import ann

    embeddings = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(embeddings, F.col("vec_id") % 20 == 0, k=20)

# 8 Mixing sources ---------------------------------------------------------------------

# The domain of a source goes by its number; sources without one are a domain of their own.
DOMAINS = ("crawl", "news", "books", "forum")
_DOMAIN_WEIGHTS = {"crawl": 4, "news": 2, "books": 3, "forum": 1, "other": 1}


def source_tree() -> list:
    """Domain, language and source of a document."""
    number = F.regexp_extract("source", r"([0-9]+)$", 1).try_cast("long")
    names = F.lit(list(DOMAINS))
    domain = F.get(names, F.pmod(F.floor(number / 5), F.lit(len(DOMAINS))).cast("int"))
    return [F.coalesce(domain, F.lit("other")), F.col("lang"), F.col("source")]


def text_tokens():
    """The usual estimate: four bytes a token."""
    return F.ceil(F.octet_length("text") / 4)


def source_mix(share: float, epochs: int):
    """Target weights of domains, and English with three times another language's weight."""
    from sendgate.llm.mixing import Mix

    weights = {(domain,): weight for domain, weight in _DOMAIN_WEIGHTS.items()}
    weights |= {(domain, "en"): 3 for domain in _DOMAIN_WEIGHTS}
    return Mix(weights=weights, share=share, epochs=epochs, seed=20)


@_query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import mixing

    documents = _table(spark, sf_dir, "documents")
    mixed = mixing.mix_sources(documents, source_tree(), text_tokens(), source_mix(1.0, 2))
    return mixed.select("doc_id", "lang", "source", "epoch", "leaf_budget", "mix_tokens")

# 6 Line dedup -------------------------------------------------------------------------


@_query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import line_dedup

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_recurring_lines(documents, tree=line_dedup.WHOLE)
    return kept.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped"),
        F.md5(F.to_binary("text", F.lit("utf-8"))).alias("text_md5"),
    )


ORACLES["op6_line_dedup"] = r"""
with texts as (
    select distinct text from documents where text is not null
), lines as (
    select text, unnest(string_split(text, chr(10))) as line,
           unnest(range(len(string_split(text, chr(10))))) as place
    from texts
), worded as (
    select *, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
    from lines
), known as (
    select *, len(words) as n from worded where len(words) > 0
), leaved as (
    select *, list_transform(words[:least(3, len(words) // 3)],
           lambda w: case when regexp_matches(w, '[0-9]') then '<*>' else w end) as lead_words
    from known where n >= 3
), different as (
    select n, lead_words, line, any_value(words) as words, count(distinct text) as texts
    from leaved group by n, lead_words, line
), leaf_texts as (
    select n, lead_words from leaved group by n, lead_words having count(distinct text) >= 5
), spread as (
    select n, lead_words, line, texts, unnest(words) as word, unnest(range(len(words))) as spot
    from different semi join leaf_texts using (n, lead_words)
), constant as (
    select n, lead_words, spot, word from spread where not regexp_matches(word, '[0-9]')
    group by n, lead_words, spot, word having sum(texts) >= 5
), templates as (
    select n, lead_words, line, list((spot, word) order by spot) as template, count(*) as fixed
    from spread join constant using (n, lead_words, spot, word)
    group by n, lead_words, line
), templated as (
    select text, place, leaved.n, leaved.lead_words, template
    from leaved join templates using (n, lead_words, line) where fixed >= leaved.n * 0.7
), recurring as (
    select n, lead_words, template from templated
    group by n, lead_words, template having count(distinct text) >= 5
), masked as (
    select text, place, n, 'leaf ' || n || lead_words::varchar || template::varchar as name, 5 as floor
    from templated semi join recurring using (n, lead_words, template)
), asked as (
    -- As they stand: passages from two texts on, and the shorter a line, the more texts it takes.
    select *, case when n >= 50 then 2 when n < 3 then ceil(15 / n)::bigint else 5 end as floor from known
), repeats as (
    select line, floor from asked group by line, floor having count(distinct text) >= floor
), found as (
    select * from masked
    union all
    select text, place, n, 'line ' || line, floor
    from asked semi join repeats using (line) anti join masked using (text, place)
), held as (
    select text, sum(n) as repeated from found group by text
), sizes as (
    select text, sum(n) as words from known group by text
), shares as (
    select *, repeated < words * 0.8571428571428571::double as differs from held join sizes using (text)
), own as (
    select name, floor, text, sum(n) as own from found group by all
), everywhere as (
    select name from own join shares using (text) group by name, floor
    having count(*) filter (words > own and repeated - own <= (words - own) * 0.5)
               >= greatest(floor, count(*) * 0.5)
        or count(*) filter (differs) >= greatest(5, count(*) * 0.5)
), minor as (
    select text from shares where repeated <= words * 0.5
), dropped as (
    select text, place from found semi join everywhere using (name)
    union select text, place from found semi join minor using (text)
), listed as (
    select text, count(*) as n_dropped, string_agg(place, ',' order by place) as dropped
    from dropped group by text
), kept as (
    select l.text, string_agg(line, chr(10) order by place) as kept
    from lines as l anti join dropped as d on d.text = l.text and d.place = l.place group by l.text
)
select doc_id, len(string_split(d.text, chr(10))) as n_lines, coalesce(n_dropped, 0) as n_dropped,
       coalesce(dropped, '') as dropped,
       case when d.text is not null then md5(coalesce(kept, '')) end as text_md5
from documents as d left join listed on listed.text = d.text left join kept on kept.text = d.text
"""

# 3 N-gram Jaccard join ----------------------------------------------------------------


@_query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import jaccard_join

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    linked = jaccard_join.link_documents(documents, links=True)
    return linked.select("doc_id", "n_shingles", "component_id", "class_id", "n_links")

# 11 Conversation prefix trie ----------------------------------------------------------

NO_MEMBERS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import prefix_trie

    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv = F.col("conv_id")
    head = F.crc32(F.to_binary(conv.cast("string"), F.lit("utf-8"))) % 9
    recipes = turns.select("conv_id").distinct().select(
        "conv_id", (conv - conv % 5).alias("base_id"), head.alias("head")
    )
    trie = prefix_trie.prefix_trie(turns, recipes)
    nodes = trie.nodes.withColumnRenamed("saved_bytes", "saved_tokens")
    digests = prefix_trie.ends_digest(trie.ends)
    ends = F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256")
    return nodes.join(digests, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends
    )


ORACLES["op11_prefix_trie"] = """
with stored as (
    select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                         order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
    from conversations where conv_id is not null group by conv_id
), heads as (
    select conv_id, turns, xor(list_reduce(
        list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint),
        lambda crc, byte: list_reduce(range(8), lambda x, bit:
            case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end, xor(crc, byte)),
        4294967295::bigint), 4294967295::bigint) % 9 as h
    from stored
), rebuilt as (
    select o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) as turns
    from heads as o left join stored as b on b.conv_id = o.conv_id - o.conv_id % 5
), prefixes as (
    select conv_id, turns[1:depth] as prefix, depth, depth = len(turns) as ended
    from (select conv_id, turns, unnest(range(len(turns) + 1)) as depth from rebuilt)
), nodes as (
    select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256
    from prefixes group by prefix, depth
), children as (
    select prefix[1:depth - 1] as prefix, depth - 1 as depth, count(*) as n_children
    from nodes where depth > 0 group by all
), sized as (
    select n.*, coalesce(n_children, 0) as n_children,
           case when n.depth = 0 then 0
                else (n_convs - 1) * strlen(n.prefix[n.depth].text) end as saved
    from nodes as n left join children as c on c.prefix = n.prefix and c.depth = n.depth
), above as (
    select *, unnest(range(depth + 1)) as top from sized
), subtrees as (
    select prefix[1:top] as prefix, top as depth, count(*) filter (n_children = 0) as n_leaves,
           sum(saved) as saved_tokens
    from above group by all
)
select s.conv_id, s.depth, p.conv_id as parent_conv_id, s.n_convs, s.n_children, t.n_leaves,
       t.saved_tokens::bigint as saved_tokens, s.ends_sha256
from sized as s
join subtrees as t on t.prefix = s.prefix and t.depth = s.depth
left join nodes as p on s.depth > 0 and p.depth = s.depth - 1 and p.prefix = s.prefix[1:s.depth - 1]
"""

# 13 Substring dedup -------------------------------------------------------------------


@_query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import substring_dedup

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substring_dedup.drop_repeats(documents, length=13, settled=True)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op13_substring_dedup"] = r"""
with texts as (
    select row_number() over () as row_no, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
    from documents
), windows as (
    select row_no, doc_id, first_word, array_to_string(words[first_word:first_word + 12], ' ') as run
    from (select *, unnest(range(1, len(words) - 11)) as first_word from texts)
), least as (
    select run, min(doc_id) as least from windows group by run
), covered as (
    select distinct row_no, unnest(range(first_word, first_word + 13)) as place
    from windows join least using (run) where least < doc_id
), placed as (
    select row_no, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from texts
), kept as (
    select row_no, count(*) as n_kept, string_agg(word, ' ' order by place) as kept
    from placed anti join covered using (row_no, place) group by row_no
)
select doc_id, len(words) as n_words, len(words) - coalesce(n_kept, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from texts left join kept using (row_no)
"""

# 12 Ranked lexical search -------------------------------------------------------------


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sendgate.llm import lexical_search

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    items = _table(spark, sf_dir, "benchmark").select("item_id", "text")
    return lexical_search.search(documents, items, k=20)


ORACLES["op12_lexical_search"] = r"""
with texts as (
    select 'd' as kind, row_number() over () as row_no, doc_id as id, text from documents
    union all select 'q', row_number() over (), item_id, text from benchmark
), split as (
    select kind, row_no, id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from texts where text is not null
), docs as (
    select row_no, id as doc_id, terms, len(terms) as n from split where kind = 'd' and len(terms) > 0
), totals as (
    select count(*) as n_docs, sum(n)::bigint as n_words from docs
), counts as (
    select row_no, doc_id, term, count(*) as tf, any_value(n) as n
    from (select row_no, doc_id, n, unnest(terms) as term from docs) group by row_no, doc_id, term
), weights as (
    select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w
    from counts, totals group by term, n_docs
), asked as (
    select row_no as q, id as item_id, unnest(terms) as term from split where kind = 'q'
), scores as (
    select q, item_id, row_no, doc_id, sum(w * ((1000000000 * tf)
               // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words))))::bigint as score
    from asked join counts using (term) join weights using (term), totals group by q, item_id, row_no, doc_id
), ranked as (
    select *, row_number() over (partition by q order by score desc, doc_id nulls first) as rank
    from scores where score > 0
)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 20
"""
