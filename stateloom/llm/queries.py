"""The operators as queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stateloom.llm import centroids, decontaminate, factoring, langid, minhash, mixing, neighbours, phrases, pii, substrings, url_filter, warc, wrappers
from stateloom.llm.shared import importable, kept


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# The rules of the url query.
URL_RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


def op1_url_filter(spark, sf):
    return url_filter.judge_urls(table(spark, sf, "pages").select("page_id", "url"), URL_RULES).select("page_id", "judged.*")


def op2_warc_seekable(spark, sf):
    folder, index = warc.write_bundles(warc.as_records(table(spark, sf, "pages")))
    return warc.resolve_revisits(warc.read_records(spark, folder, index, with_payload=False))


def op3_decontamination(spark, sf):
    documents = table(spark, sf, "documents")
    marked, _ = decontaminate.mark_contaminated(documents, table(spark, sf, "benchmark"), keep=["doc_id", "text"])
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontaminate.items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


MIX_WEIGHTS = [3.0, 1.0, 2.0]


def op4_mixing(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "source")
    mixed, plan = mixing.mix(documents, "text", F.array("source"), MIX_WEIGHTS)
    rows = [(s, plan["sizes"][s], plan["targets"][s]) for s in plan["sizes"]]
    # a row per source
    of_source = spark.createDataFrame(rows, "name string, source_size long, target double")
    joined = mixed.join(F.broadcast(of_source), F.col("source").eqNullSafe(F.col("name")), "left")
    return joined.select("doc_id", "mixed.size", "source_size", "target", "mixed.taken")


def op5_language_id(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    profiles = kept(langid.learn_profiles(documents.filter(~langid.held_out(F.col("doc_id")))), "language-profiles")
    judged, _ = langid.identify(documents, profiles, keep=["doc_id", "text"])
    return judged.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_minhash_near_dedup(spark, sf):
    found = minhash.near_duplicates(table(spark, sf, "documents"), options=minhash.Options(words=4))
    return minhash.components_by_document(found).select("doc_id", "n_shingles", "component_id", "kept")


def op7_suffix_dedup(spark, sf):
    cut = substrings.remove_repeats(table(spark, sf, "documents"), with_text=False)
    return cut.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_nn_descent(spark, sf):
    return neighbours.nearest_neighbours(table(spark, sf, "embeddings"), F.col("key") % 100 == 0)


def op9_html_extraction(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return wrappers.extract(pages, kept(wrappers.induce(pages), "wrappers"))


PII_KEY = "stateloom"  # for the query; a user takes a secret one


def op10_pii_pseudonyms(spark, sf):
    hidden = pii.with_pseudonyms(table(spark, sf, "documents").select("doc_id", "text"), PII_KEY, "text", "found")
    return hidden.select("doc_id", F.col("found.text").alias("text"), F.col("found.n").cast("long").alias("n_replaced"))


def op11_phrase_collocations(spark, sf):
    return phrases.collocations(table(spark, sf, "documents"))


def op12_substring_dedup(spark, sf):
    cut = factoring.remove_repeated_windows(table(spark, sf, "documents"), with_text=False)
    return cut.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op13_centroid_clustering(spark, sf):
    assigned, points = centroids.cluster(table(spark, sf, "embeddings"))
    return centroids.with_inertia(assigned, points).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


LLM_QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_warc_seekable": op2_warc_seekable,
    "op3_decontamination": op3_decontamination,
    "op4_mixing": op4_mixing,
    "op5_language_id": op5_language_id,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_nn_descent": op8_nn_descent,
    "op9_html_extraction": op9_html_extraction,
    "op10_pii_pseudonyms": op10_pii_pseudonyms,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_centroid_clustering": op13_centroid_clustering,
}

OP1_SQL = r"""
with parts as (
    select page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages
), ruled as (
    select *, case
        when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
        when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
        when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/'
        when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
        when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
    end as rule
    from parts
)
select page_id, host, path, rule,
    case when rule in ('example.org/es/', 'example.org/en/1', 'com/de/') then 'block' else 'allow' end as verdict
from ruled
"""

OP2_SQL = """
with rows as (
    select page_id, sha256(coalesce(html, '')) as payload_digest, strlen(coalesce(html, ''))::bigint as payload_bytes from pages
), firsts as (
    select payload_digest, min(page_id) as first_id from rows where payload_bytes >= 100 group by 1
)
select page_id, payload_bytes, rows.payload_digest,
    case when first_id is not null and page_id <> first_id then 'revisit' else 'response' end as record_type,
    case when page_id <> first_id then first_id end as refers_to
from rows left join firsts on rows.payload_digest = firsts.payload_digest and payload_bytes >= 100
"""

OP3_SQL = r"""
with item_words as (
    select item_id::varchar as item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where text is not null
), windows as (
    select distinct item, list_slice(w, k, k + least(10, len(w)) - 1) as gram
    from (select item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as k from item_words where len(w) > 0)
), doc_words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), grams as (
    select doc_id, k, size, list_slice(w, k, k + size - 1) as gram
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as k from doc_words, (select distinct len(gram) as size from windows))
), found as (
    select doc_id, k, size, item from grams join windows using (gram)
), hit as (
    select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(k, k + size)) as place from (select distinct doc_id, k, size from found)) group by 1
), named as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from found) group by 1
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit using (doc_id) left join named using (doc_id)
"""

OP11_SQL = r"""
with pieces as materialized (
    select row_number() over () as piece, lang, regexp_extract_all(part, '[^\x20\x09]+') as w
    from (
        select coalesce(lang, 'und') as lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as part
        from documents
    )
), sizes as (
    select lang, sum(len(w))::bigint as n from pieces group by 1
), counts as materialized (
    select lang, w, count(*) as f
    from (select lang, list_slice(w, k, k + size - 1) as w from (
        select lang, w, size, unnest(range(1, len(w) - size + 2)) as k from pieces, range(1, 6) sizes(size) where len(w) >= size
    )) group by 1, 2 having count(*) >= 100
), cuts as (
    select c.lang, c.w, c.f as a, k, l.f as l, r.f as r, (1000::hugeint * c.f * n) // (l.f::hugeint * r.f) as score
    from (select *, unnest(range(1, len(w))) as k from counts where len(w) > 1) c
    join sizes s on s.lang = c.lang
    join counts l on l.lang = c.lang and l.w = list_slice(c.w, 1, k)
    join counts r on r.lang = c.lang and r.w = list_slice(c.w, k + 1, len(c.w))
), lowest as (
    select * from cuts qualify row_number() over (partition by lang, w order by score, k) = 1
), inside as (
    select lang, list_slice(w, k, k + size - 1) as w, max(f) as f
    from (select lang, w, f, size, unnest(range(1, len(w) - size + 2)) as k from counts, range(2, 5) sizes(size) where len(w) > size) group by 1, 2
), ranked as (
    select lowest.lang, array_to_string(lowest.w, ' ') as phrase, a, l, r, n, score::bigint as score,
        row_number() over (partition by lowest.lang order by score desc, a desc, array_to_string(lowest.w, ' ')) as rank
    from lowest join sizes on sizes.lang = lowest.lang left join inside on inside.lang = lowest.lang and inside.w = lowest.w
    where inside.f is null or 100 * inside.f < 100 * a
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""

OP12_SQL = r"""
with words as materialized (
    select row_number() over () as row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as materialized (
    select row, doc_id, k, md5(array_to_string(list_slice(w, k, k + 12), ' ')) as gram
    from (select row, doc_id, w, unnest(range(1, len(w) - 11)) as k from words where len(w) >= 13)
), firsts as (
    select gram, min(doc_id) as first_id from windows group by 1 having min(doc_id) < max(doc_id)
), gone as (
    select row, list(distinct place) as places from (
        select row, unnest(range(k, k + 13)) as place from windows join firsts using (gram) where first_id < doc_id
    ) group by 1
)
select doc_id, len(w)::bigint as n_words, coalesce(len(places), 0)::bigint as n_removed,
    sha256(array_to_string(case when places is null then w else list_filter(w, lambda x, i: not list_contains(places, i)) end, ' ')) as kept_sha256
from words left join gone using (row)
"""


def op13_sql(rounds: int = 10) -> str:
    """One block of common tables for each round; r<i> has the centroids after round i."""
    assign = """d{i} as materialized (
    select v.row, c.cluster, sum((v.x - c.x) * (v.x - c.x))::bigint as distance from parts v join r{i} c using (place) group by 1, 2
), a{i} as materialized (
    select row, cluster, distance from d{i} qualify row_number() over (partition by row order by distance, cluster) = 1
)"""
    move = """m{i} as materialized (
    select a.cluster, v.place, sum(v.x) as s, count(*)::hugeint as n from a{i} a join parts v using (row) group by 1, 2
), r{j} as materialized (
    select r.cluster, r.place, coalesce(((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::bigint, r.x) as x from r{i} r left join m{i} m using (cluster, place)
)"""
    steps = [assign.format(i=i) + ", " + move.format(i=i, j=i + 1) for i in range(rounds)]
    return f"""
with kept as materialized (
    select row_number() over () as row, vec_id, embedding as v from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
    select row, unnest(range(1, 65)) as place, unnest(list_transform(v, lambda x: floor(1024 * x::double)::bigint)) as x from kept
), seeds as materialized (
    select row, row_number() over (order by sha256('3:' || vec_id), v) - 1 as cluster from kept qualify cluster < 8
), r0 as materialized (
    select cluster, place, x from seeds join parts using (row)
), {", ".join(steps)}, {assign.format(i=rounds)}, sums as (
    select cluster, sum(distance)::bigint as cluster_inertia from a{rounds} group by 1
), digests as (
    select cluster, sha256(string_agg(x::varchar, ',' order by place)) as centroid_sha256 from r{rounds} group by 1
)
select vec_id, cluster::int as cluster, distance, cluster_inertia, (select sum(distance)::bigint from a{rounds}) as inertia, centroid_sha256
from a{rounds} join kept using (row) join sums using (cluster) join digests using (cluster)
"""


LLM_ORACLES = {
    "op1_url_filter": OP1_SQL,
    "op2_warc_seekable": OP2_SQL,
    "op3_decontamination": OP3_SQL,
    "op11_phrase_collocations": OP11_SQL,
    "op12_substring_dedup": OP12_SQL,
    "op13_centroid_clustering": op13_sql(),
}
