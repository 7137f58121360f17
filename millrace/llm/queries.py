"""One query per operator over the whole test tables, with its DuckDB statement where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from . import context_trees, conversations, fingerprints, language, manifest, mixing, neardup, oracles, pieces, quality, sharding, substrings, urls, vectors
from .common import ship

URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"))


def op2_nb_support_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_held_out(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), shards=8, store=new_path(spark, "slot-map"))


def op4_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op5_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op6_minhash_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(read(spark, sf_dir, "documents")).drop("class_id")


def op7_marginal_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(read(spark, sf_dir, "documents"))


def op8_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors_ = read(spark, sf_dir, "embeddings")
    return vectors.nearest(vectors_, vectors_.where(F.col("vec_id") % 20 == 0))


def op9_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(read(spark, sf_dir, "documents"))


def op10_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(read(spark, sf_dir, "documents"))


def op11_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_trees.score_held_out(read(spark, sf_dir, "documents"))


def op12_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(read(spark, sf_dir, "conversations")))


def op13_butterfly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(read(spark, sf_dir, "documents"), manifest.tampered_leaf())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_nb_support_vectors,
        op3_virtual_slots,
        op4_sainte_lague,
        op5_url_trie,
        op6_minhash_bands,
        op7_marginal_unigrams,
        op8_vantage_point,
        op9_minhash_fingerprints,
        op10_difference_cover,
        op11_context_trees,
        op12_four_russians,
        op13_butterfly_manifest,
    )
}

ORACLES: dict[str, str] = {
    "op12_four_russians": oracles.REPAIR,
    "op13_butterfly_manifest": oracles.MANIFEST,
    "op6_minhash_bands": r"""
        with recursive words as (
            select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') as w from documents),
        sets as (
            select distinct doc_id, w[pos:pos + 4] as shingle
            from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as pos from words where len(w) > 0)),
        sizes as (select doc_id, count(*) as n from sets group by doc_id),
        common as (
            select a.doc_id as a, b.doc_id as b, count(*) as n_common from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id
            group by all),
        links as (
            select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * n_common >= 75 * (x.n + y.n - n_common)),
        edges as (select a, b from links union select b, a from links),
        reach (doc_id, other) as (
            select doc_id, doc_id from documents union select r.doc_id, e.b from reach r join edges e on e.a = r.other)
        select d.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(other) as component_id, d.doc_id = min(other) as kept
        from documents d join reach r using (doc_id) left join sizes s using (doc_id) group by d.doc_id""",
    "op10_difference_cover": r"""
        with words as (
            select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
        windows as (
            select doc_id, pos, row_number() over (partition by body order by doc_id, pos) as place
            from (select doc_id, pos, w[pos:pos + 19] as body
                  from (select doc_id, w, unnest(range(1, len(w) - 18)) as pos from words where len(w) >= 20))),
        gone as (select distinct doc_id, unnest(range(pos, pos + 20)) as pos from windows where place > 1),
        each as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from words),
        left_over as (
            select e.doc_id, string_agg(e.word, ' ' order by e.pos) as kept, count(*) as n
            from each e anti join gone g on g.doc_id = e.doc_id and g.pos = e.pos group by e.doc_id)
        select d.doc_id, len(d.w)::bigint as n_words, (len(d.w) - coalesce(l.n, 0))::bigint as n_removed,
               sha256(coalesce(l.kept, '')) as kept_sha256
        from words d left join left_over l using (doc_id)""",
    "op8_vantage_point": """
        with good as (
            select distinct vec_id, embedding::double[] as v from embeddings
            where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        scored as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score
            from good q join good c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0)
        select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
        from scored qualify rank <= 20""",
    "op5_url_trie": r"""
        with parted as (
            select page_id,
                   coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
            from pages),
        rules (verdict, rule, domain, beginning) as (values
            ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
            ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/'))
        select p.page_id, p.host, p.path, max_by(r.rule, length(r.rule)) as rule,
               coalesce(max_by(r.verdict, length(r.rule)), 'allow') as verdict
        from parted p left join rules r
          on (p.host = r.domain or ends_with(p.host, '.' || r.domain)) and starts_with(p.path, r.beginning)
        group by p.page_id, p.host, p.path""",
}
