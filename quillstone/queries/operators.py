"""Queries that apply the library's own operators, each with SQL of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import text as T
from quillstone.functions.names import INITIALS, NO_NAME, PARTICLES, parsed
from quillstone.functions.names import quality as quality_of
from quillstone.operators import graph, linkage, quality, search
from quillstone.queries.base import frame, over, view
from quillstone.plans.checkpoint import scratch
from quillstone.sources.tables import CountMismatch, Tables, export, gate, page, read_cache, read_csv, read_json, rest_scan, write_cache, write_csv
from quillstone.streaming import incremental

# Sources.


@frame("S3_rest_scan", "select o_orderkey, o_totalprice from orders where o_totalprice >= 400000 and o_orderpriority ilike '%URGENT%' order by o_orderkey desc limit 50")
def rest(t: Tables) -> DataFrame:
    return rest_scan(t.orders, select="o_orderkey,o_totalprice", where={"o_totalprice": "gte.400000", "o_orderpriority": "ilike.*urgent*"}, order="o_orderkey.desc", limit=50)


@frame("S4_namespaces", "select 'a' as ns, count(*) as n from nation union all select 'b', count(*) from nation where n_regionkey = 1")
def namespaces(t: Tables) -> DataFrame:
    t.nation.createOrReplaceTempView("a_papers")
    t.nation.where("n_regionkey = 1").createOrReplaceTempView("b_papers")
    return t.spark.sql("select 'a' as ns, count(*) as n from a_papers union all select 'b', count(*) from b_papers")


@frame("S5_pagination", "select c_custkey, c_name from customer order by c_custkey limit 40 offset 80")
def pages(t: Tables) -> DataFrame:
    return page(t.customer.select("c_custkey", "c_name"), order=["c_custkey"], size=40, number=2)


@frame("S6_json_fields", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events where event_type = 'click'")
def json_fields(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'click'").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@frame("S7_cache_lookup", "select cast(n_nationkey as varchar) as key, case when n_nationkey % 2 = 0 then n_name end as value from nation")
def cache_lookup(t: Tables) -> DataFrame:
    """A cache of gzipped JSON lines is written, read, completed from the registry, written again, and asked."""
    path = scratch(t.spark, "cache")
    nation = t.nation.select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value"), "n_nationkey")
    write_cache(nation.where("n_nationkey % 4 = 0"), f"{path}/first")
    registry = nation.where("n_nationkey % 2 = 0").select("key", "value")
    _, full = incremental.lookup(nation.select("key"), read_cache(t.spark, f"{path}/first"), lambda missing: registry.join(missing, "key", "left_semi"))
    write_cache(full, f"{path}/full")

    def nothing(missing: DataFrame) -> DataFrame:
        return missing.select("key", F.lit("asked again").alias("value"))

    return incremental.lookup(nation.select("key"), read_cache(t.spark, f"{path}/full"), nothing)[0]


@frame("S9_projected_columns", "select r_regionkey, r_name from region")
def projected(t: Tables) -> DataFrame:
    """A CSV with a byte order mark and only the columns asked for that there are, read back."""
    path = scratch(t.spark, "csv")
    write_csv(t.region, path, ("r_regionkey", "r_name", "absent"), bom=True)
    raw = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).where(F.hex(F.substring("content", 1, 3)) == "EFBBBF")
    header = raw.select(F.split(F.decode(F.substring("content", 4, 1000), "UTF-8"), "\n")[0].alias("h")).first().h
    return read_csv(t.spark, path, ", ".join(f"{c} {t.region.schema[c].dataType.simpleString()}" for c in header.split(",")))


def release_frames(t: Tables) -> dict[str, tuple[DataFrame, list[str]]]:
    """The named outputs of a release, and their orders."""
    papers = view(t, "papers").join(view(t, "journals").select(F.col("id").alias("journal_id"), F.col("name").alias("journal")), "journal_id")
    core = ["id", "doi", "title", "abstract", "publication_year", "journal", "document_type"]
    in_scope = F.col("publication_year") >= 1997
    whole = F.coalesce(F.col("is_scientific") & F.col("abstract").isNotNull(), F.lit(False))
    authors, links = view(t, "authors"), view(t, "paper_authors")
    enriched = authors.where("orcid is not null").select(F.col("id").alias("author_id"), F.col("name").alias("name_as_published"), F.upper("name").alias("full_name"))
    talks, credits = view(t, "talks"), view(t, "talk_authors")
    return {
        "articles": (papers.where(in_scope & whole).select(*core, "is_empirical", "research_method"), ["id"]),
        "additional_records": (papers.where(in_scope & ~whole).select(*core, "is_scientific", "is_empirical", "research_method"), ["id"]),
        "supplement": (papers.where(~in_scope).select(*core), ["id"]),
        "journals": (view(t, "journals"), ["id"]),
        "authors": (authors.select("id", "name", "orcid"), ["id"]),
        "paper_authors": (links, ["paper_id", "position", "author_id"]),
        "organizations": (view(t, "organizations"), ["id"]),
        "author_affiliations": (view(t, "author_affiliations"), ["paper_id", "author_id", "organization_id"]),
        "author_name_enrichment": (enriched, ["author_id"]),
        "presentations": (talks.select("id", "year", "title", "abstract", "format", "methodology", "author_count"), ["id"]),
        "speakers": (view(t, "speakers"), ["id"]),
        "talk_authors": (credits.select("paper_id", "author_id", "author_order", "institution", "country"), ["paper_id", "author_order", "author_id"]),
    }


_WHOLE = "coalesce(is_scientific and abstract is not null, false)"
_RELEASE = {
    "articles": f"papers where publication_year >= 1997 and {_WHOLE}", "additional_records": f"papers where publication_year >= 1997 and not {_WHOLE}", "supplement": "papers where publication_year < 1997", "journals": "journals", "authors": "authors",
    "paper_authors": "paper_authors", "organizations": "organizations", "author_affiliations": "author_affiliations", "author_name_enrichment": "authors where orcid is not null", "presentations": "talks", "speakers": "speakers", "talk_authors": "talk_authors",
}


@frame("S10_release_export", over(" union all ".join(f"select '{n}' as name, count(*) as records, '{n}.csv' as file from {x}" for n, x in _RELEASE.items())))
def release(t: Tables) -> DataFrame:
    """All outputs are written in order as CSV, counted from what was written, and listed in a manifest, which is read back."""
    folder, named = scratch(t.spark, "release"), release_frames(t)
    export(t.spark, folder, {n: df for n, (df, _) in named.items()}, {"journals": t.nation.count()}, order={n: by for n, (_, by) in named.items()})
    return read_json(t.spark, f"{folder}/manifest", "name string, records long, file string")


@frame("S12_count_gate", "select 'nation' as name, count(*) as n, 25 as expected, count(*) = 25 as ok from nation")
def count_gate(t: Tables) -> DataFrame:
    """The gate lets the right count pass and stops a wrong one."""
    n = gate("nation", t.nation.count(), 25)
    try:
        gate("nation", n, n + 1)
        stopped = False
    except CountMismatch:
        stopped = True
    return t.spark.createDataFrame([("nation", n, 25, stopped)], "name string, n long, expected int, ok boolean")


@frame("S13_data_dictionary", "select 'c_custkey' as \"column\", count(c_custkey) as filled, round(100.0 * count(c_custkey) / count(*), 1)::double as pct from customer union all select 'c_name', count(c_name), round(100.0 * count(c_name) / count(*), 1)::double from customer union all select 'c_nationkey', count(c_nationkey), round(100.0 * count(c_nationkey) / count(*), 1)::double from customer union all select 'c_acctbal', count(c_acctbal), round(100.0 * count(c_acctbal) / count(*), 1)::double from customer union all select 'c_mktsegment', count(c_mktsegment), round(100.0 * count(c_mktsegment) / count(*), 1)::double from customer")
def dictionary(t: Tables) -> DataFrame:
    return quality.null_profile(t.customer)


@frame("S16_registry_search", """
    with n as (select p_partkey id, p_brand b, p_size s, p_name || ' ' || p_type x from part),
    c as (select q.id, c.id candidate, round(1 - levenshtein(q.x, c.x) / cast(greatest(length(q.x), length(c.x)) as double), 6) sim from n q join n c on c.b = q.b and abs(c.s - q.s) <= 1 and c.id <> q.id)
    select id, candidate, sim from c qualify row_number() over (partition by id order by sim desc, candidate) <= 5""")
def registry_search(t: Tables) -> DataFrame:
    """Same number, neighbouring year, then the five most similar titles."""
    ours = t.part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("issn"), F.col("p_size").alias("year"), F.concat("p_name", F.lit(" "), "p_type").alias("title"))
    return linkage.registry_search(ours, ours.withColumnRenamed("id", "candidate"), same=["issn"], band="year", width=1, text="title", sim=_rounded_sim)


def _rounded_sim(a: Column, b: Column) -> Column:
    return F.round(T.levenshtein_sim(a, b), 6)


@frame("I4_progress", "select 4 as reports, count(*) as worked from nation")
def progress(t: Tables) -> DataFrame:
    """Work in three batches, after a first report; each tells how many rows are done."""
    path, heard = scratch(t.spark, "work"), []
    done = incremental.in_batches(t.nation.select("n_nationkey"), path, lambda df: df.withColumn("name", F.upper(F.col("n_nationkey").cast("string"))), ["n_nationkey"], batches=3, report=heard.append)
    return done.agg(F.lit(len(heard)).alias("reports"), F.count(F.lit(1)).alias("worked"))


@frame("X25_today")
def today(t: Tables) -> DataFrame:
    """The current time, to the day; it has no SQL since it isn't the same twice."""
    return t.region.select("r_regionkey", F.date_format(F.current_timestamp(), "yyyy-MM-dd").alias("today"))


@frame("S18_embedding_queue", "select o_orderkey as id from orders where o_orderkey % 3 <> 0")
def embedding_queue(t: Tables) -> DataFrame:
    return incremental.pending(t.orders.select(F.col("o_orderkey").alias("id")), t.orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id")), ["id"])


@frame("S14_metadata", """
    select 'embeddings' as table_name, (select count(*) from embeddings) as n, cast(3 as bigint) as columns, 'embedding' as vectors union all select 'documents', (select count(*) from documents), cast(5 as bigint), '' union all select 'labels', (select count(*) from labels), cast(3 as bigint), ''""")
def metadata(t: Tables) -> DataFrame:
    """Exact counts, numbers of columns, and columns that hold vectors."""
    return quality.metadata({n: getattr(t, n) for n in ("embeddings", "documents", "labels")})


# Word boundaries and scalar functions.


@frame("F6_word_boundaries", r"select doc_id from documents where regexp_matches(text, '(?i)((^|[^\p{L}\p{N}_])au|the($|[^\p{L}\p{N}_]))')")
def boundaries(t: Tables) -> DataFrame:
    return t.documents.where(T.any_word(F.col("text"), [r"\mau", r"the\M"])).select("doc_id")


_TITLE = "'Review: The ' || p_name || ' &amp; ' || p_type || ' no. ' || cast(p_size as varchar)"


def _titles(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("Review: The "), "p_name", F.lit(" &amp; "), "p_type", F.lit(" no. "), F.col("p_size").cast("string")).alias("title"), "p_name", "p_type", "p_size")


_NORM = "trim(regexp_replace(lower(regexp_replace(trim(replace({x}, '&amp;', '&')), '(?i)^(book review|review essay|reviews|review|editorial|erratum|correction)\\s*[:\\-—]+\\s*', '')), '[^a-z0-9]+', ' ', 'g'))"


@frame("X6_norm_title", f"select p_partkey as id, {_NORM.format(x=_TITLE)} as t from part")
def norm_titles(t: Tables) -> DataFrame:
    return _titles(t).select("id", T.norm_title(F.col("title")).alias("t"))


@frame("X7_norm_journal", "select n_nationkey as id, 'journal of ' || lower(replace(n_name, '_', ' ')) || ' and policy' as j from nation")
def norm_journals(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("id"), T.norm_journal(F.concat(F.lit("The Journal of "), "n_name", F.lit(" &amp; Policy"))).alias("j"))


@frame("X8_title_sim_prefix", "select p_partkey as id, case when p_size % 3 = 0 then 1.0 when p_size % 3 = 1 then round(least(0.97, greatest(0.75, length(p_name) / cast(length(p_name || ' ' || p_type) as double))), 6) else 0.0 end as sim from part")
def title_sims(t: Tables) -> DataFrame:
    other = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).when(F.col("p_size") % 3 == 1, F.concat_ws(" ", "p_name", "p_type")).otherwise(F.lit(""))
    return t.part.select(F.col("p_partkey").alias("id"), F.round(T.title_sim(F.col("p_name"), other), 6).alias("sim"))


@frame("X8_title_sim_ratio")
def title_ratio(t: Tables) -> DataFrame:
    """The edit ratio of neighbouring names; SQL has no such measure."""
    pairs = t.part.select(F.col("p_partkey").alias("id"), "p_name").join(t.part.select((F.col("p_partkey") - 1).alias("id"), F.col("p_name").alias("other")), "id")
    return pairs.select("id", F.round(T.title_sim(F.col("p_name"), F.col("other")), 6).alias("sim"))


@frame("X8_levenshtein_sim", "select a.p_partkey as id, round(1 - levenshtein(a.p_name, b.p_name) / cast(greatest(length(a.p_name), length(b.p_name)) as double), 6) as sim from part a join part b on b.p_partkey = a.p_partkey + 1")
def levenshtein_sims(t: Tables) -> DataFrame:
    pairs = t.part.select(F.col("p_partkey").alias("id"), "p_name").join(t.part.select((F.col("p_partkey") - 1).alias("id"), F.col("p_name").alias("other")), "id")
    return pairs.select("id", F.round(T.levenshtein_sim(F.col("p_name"), F.col("other")), 6).alias("sim"))


@frame("X9_digits_conflict", "select p_partkey as id, p_size <> p_size + p_partkey % 2 as conflict from part")
def digit_conflicts(t: Tables) -> DataFrame:
    a = F.concat(F.lit("part 00"), F.col("p_size").cast("string"))
    b = F.concat(F.lit("Part no "), (F.col("p_size") + F.col("p_partkey") % 2).cast("string"))
    return t.part.select(F.col("p_partkey").alias("id"), T.digits_conflict(a, b).alias("conflict"))


@frame("X10_name_tokens", "select p_partkey as id, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(lower(p_name || ' of ' || p_type), '[^a-z]+'), lambda x: length(x) > 2))), '|') as toks from part")
def token_sets(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), F.array_join(F.array_sort(T.name_tokens(F.concat_ws(" of ", "p_name", "p_type"))), "|").alias("toks"))


@frame("X11_jaccard", "with p as (select p_partkey id, string_split(p_name, ' ') a from part) select x.id, round(len(list_intersect(x.a, y.a)) / cast(len(list_distinct(list_concat(x.a, y.a))) as double), 6) as j from p x join p y on y.id = x.id + 1")
def jaccards(t: Tables) -> DataFrame:
    a = t.part.select(F.col("p_partkey").alias("id"), F.split("p_name", " ").alias("a"))
    return a.join(a.select((F.col("id") - 1).alias("id"), F.col("a").alias("b")), "id").select("id", F.round(T.jaccard(F.col("a"), F.col("b")), 6).alias("j"))


@frame("X13_identifiers", over("select id, coalesce(regexp_matches(doi, '^10\\.[0-9]{4,9}/\\S+$'), false) as valid, case when regexp_matches(doi, '^oai:.*jssw-([0-9]+)$') then '10.5555/jssw.' || regexp_extract(doi, '^oai:.*jssw-([0-9]+)$', 1) end as rule from papers"))
def identifiers(t: Tables) -> DataFrame:
    return view(t, "papers").select("id", T.is_valid_doi(F.col("doi")).alias("valid"), T.oai_to_doi(F.col("doi"), "^oai:.*jssw-([0-9]+)$", "10.5555/jssw.").alias("rule"))


@frame("X14_strip_accents", "select doc_id, strip_accents(lower(text)) as t from documents where lang in ('fr', 'es')")
def accents(t: Tables) -> DataFrame:
    return t.documents.where(F.col("lang").isin("fr", "es")).select("doc_id", T.strip_accents(F.lower("text")).alias("t"))


@frame("X15_demojibake", "select n_nationkey as id, 'é' || n_name as mended from nation")
def mojibake(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("id"), T.demojibake(F.concat(F.lit("Ã©"), "n_name")).alias("mended"))


@frame("X20_distinct_years", over("select paper_id, count(distinct position % 4) as n from paper_authors group by 1"))
def distinct_years(t: Tables) -> DataFrame:
    return view(t, "paper_authors").groupBy("paper_id").agg(F.size(F.array_distinct(F.collect_list(F.col("position") % 4))).cast("long").alias("n"))


@frame("X21_year_verdict", over("select id, case when id % 5 = 0 then 'unknown' when id % 3 = 0 then 'match' when id % 3 = 1 then 'match_offset_1' else 'mismatch' end as verdict from papers"))
def year_verdicts(t: Tables) -> DataFrame:
    y = F.col("publication_year")
    years = F.when(F.col("id") % 5 == 0, F.array().cast("array<bigint>")).otherwise(F.array(y + F.element_at(F.array(F.lit(0), F.lit(1), F.lit(4)), (F.col("id") % 3 + 1).cast("int")), y + 9))
    return view(t, "papers").select("id", T.year_verdict(y, years).alias("verdict"))


@frame("X22_journal_match", "select n_nationkey as id, case when n_nationkey % 4 = 0 then 'match' when n_nationkey % 4 = 1 then 'mismatch' when n_nationkey % 4 = 2 then 'match' else 'unknown' end as verdict, case when n_nationkey % 4 < 2 then 'issn' when n_nationkey % 4 = 2 then 'name' else 'no_container_title' end as basis from nation")
def journal_matches(t: Tables) -> DataFrame:
    k = F.col("n_nationkey") % 4
    none = F.array().cast("array<string>")
    ours = F.when(k < 2, F.array(F.lit("1111-1111"))).otherwise(none)
    theirs = F.when(k == 0, F.array(F.lit("1111-1111"), F.lit("2"))).when(k == 1, F.array(F.lit("9"))).otherwise(none)
    name = F.when(k == 3, F.lit("")).otherwise(F.concat(F.lit("The "), "n_name"))
    return t.nation.select(F.col("n_nationkey").alias("id"), T.journal_match(ours, theirs, F.col("n_name"), name).alias("m")).select("id", "m.verdict", "m.basis")


@frame("X24_split_names", over("select paper_id, count(*) as n from paper_authors group by 1"))
def split_lists(t: Tables) -> DataFrame:
    joined = view(t, "paper_authors").groupBy("paper_id").agg(F.array_join(F.collect_list(F.col("author_id").cast("string")), " ; ").alias("names"))
    return joined.select("paper_id", F.size(T.split_names(F.col("names"))).cast("long").alias("n"))


@frame("X28_ramp", "select l_orderkey as k, sum(case when l_returnflag = 'A' then 1 when l_returnflag = 'R' then 0.5 else 0 end)::double / count(*) as score from lineitem group by 1")
def ramps(t: Tables) -> DataFrame:
    w = F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "R", 0.5).otherwise(0.0)
    return t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg((F.sum(w) / F.count(F.lit(1))).alias("score"))


@frame("A13_json_rows", "select n_regionkey as region, count(*) as n, max(n_name) as last from nation group by 1")
def json_rows(t: Tables) -> DataFrame:
    rows = t.nation.groupBy(F.col("n_regionkey").alias("region")).agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("rows"))
    back = F.from_json("rows", "array<struct<n_nationkey: int, n_name: string>>")
    return rows.select("region", F.size(back).cast("long").alias("n"), F.array_max(back["n_name"]).alias("last"))


@frame("A15_crosstab", "select o_orderpriority as priority, count(*) filter (where o_orderstatus = 'F') as f, count(*) filter (where o_orderstatus = 'O') as o, count(*) filter (where o_orderstatus = 'P') as p from orders group by 1")
def crosstab(t: Tables) -> DataFrame:
    wide = t.orders.groupBy(F.col("o_orderpriority").alias("priority")).pivot("o_orderstatus", ["F", "O", "P"]).count()
    return wide.select("priority", *[F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ("F", "O", "P")])


_WILSON = "round(greatest(0.0, ((k/n) + 3.8416/(2*n))/(1+3.8416/n) - 1.96*sqrt((k/n)*(1-k/n)/n + 3.8416/(4*n*n))/(1+3.8416/n)), 4) as low, round(least(1.0, ((k/n) + 3.8416/(2*n))/(1+3.8416/n) + 1.96*sqrt((k/n)*(1-k/n)/n + 3.8416/(4*n*n))/(1+3.8416/n)), 4) as high"


@frame("A24_wilson", f"select source, {_WILSON} from (select source, cast(sum(quality) as double) k, cast(count(*) as double) n from documents join labels using (doc_id) group by 1)")
def wilsons(t: Tables) -> DataFrame:
    g = t.documents.join(t.labels, "doc_id").groupBy("source").agg(F.sum("quality").cast("double").alias("k"), F.count(F.lit(1)).cast("double").alias("n"))
    return g.select("source", T.wilson(F.col("k"), F.col("n")).alias("w")).select("source", "w.low", "w.high")


@frame("A20_majority_vote", "with c as (select source, lang, count(*) n from documents group by 1, 2), r as (select *, cast(sum(n) over (partition by source) as bigint) total, row_number() over (partition by source order by n desc, lang) rn from c) select source, lang, n, total, round(n / total::double, 4) as agreement, case when total < 10 then 'too_few_votes' when n / total::double < 0.65 then 'no_agreement' else 'proposed' end as verdict from r where rn = 1")
def votes(t: Tables) -> DataFrame:
    return linkage.majority(t.documents, key="source", vote="lang", share=0.65)


@frame("O5_stratified_sample", over("select research_method, id from (select research_method, id, row_number() over (partition by research_method order by (id * 2654435761) % 1000003, id) rn from papers) where rn <= 20"))
def strata(t: Tables) -> DataFrame:
    return linkage.hash_sample(view(t, "papers").select("research_method", "id"), by=["research_method"], id_col="id", n=20).select("research_method", "id")


@frame("U3_union_first_wins", over("with a as (select id, 0 arm from papers where research_method = '1-URGENT' and publication_year = 1996 union all select id, 1 from papers where publication_year = 1996 and is_empirical union all select id, 2 from papers where journal_id = 3) select id, min(arm) as arm, string_agg(distinct arm::varchar, ',' order by arm::varchar) as arms from a group by 1"))
def union_arms(t: Tables) -> DataFrame:
    p = view(t, "papers").select("id", "research_method", "publication_year", "is_empirical", "journal_id")
    arms = [p.where("research_method = '1-URGENT' and publication_year = 1996"), p.where("publication_year = 1996 and is_empirical"), p.where("journal_id = 3")]
    return linkage.union_first([a.select("id") for a in arms]).select("id", "arm", F.array_join(F.transform("arms", lambda x: x.cast("string")), ",").alias("arms"))


@frame("U7_stratified_union", over("with a as (select id, 0 s from papers where doi is null union all select id, 1 from papers where abstract is null union all select id, 2 from papers where publication_year = 1999) select id, min(s) as stratum from a group by 1"))
def strata_union(t: Tables) -> DataFrame:
    p = view(t, "papers")
    return linkage.stratified([p.where("doi is null").select("id"), p.where("abstract is null").select("id"), p.where("publication_year = 1999").select("id")])


# Search.

_W = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"


def _bm25(terms: list[str], test: str) -> str:
    tf = ", ".join(f"len(list_filter(w, lambda x: x = '{x}'))::double tf{i}" for i, x in enumerate(terms))
    df = ", ".join(f"count(*) filter (where tf{i} > 0)::double df{i}" for i in range(len(terms)))
    score = " + ".join(f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * len / mean))" for i in range(len(terms)))
    return f"d0 as (select doc_id id, text, {_W} w from documents), d as (select id, text, w, len(w)::double len, {tf} from d0), st as (select count(*)::double n, avg(len) mean, {df} from d), kw as (select id, round({score}, 6) score from d cross join st where {test})"


_AND = _bm25(["thanea", "thanedble"], "tf0 > 0 and tf1 > 0")
_PHRASE = "contains(' ' || array_to_string(w, ' ') || ' ', ' of the ')"


def _docs(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id"), "text")


def _vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), "embedding", "label")


def _first_vector(t: Tables) -> DataFrame:
    return t.embeddings.where("vec_id = 0").select(F.col("embedding").alias("q"))


@frame("T1_keyword_search", f"with {_AND} select id, score from kw order by score desc, id limit 10")
def keyword(t: Tables) -> DataFrame:
    return search.keyword_search(_docs(t), "thanea thanedble")


def _stem_sql(x: str) -> str:
    for pattern, by in search.STEMS:
        x = f"regexp_replace({x}, '{pattern}', '{by}')"
    return x


_YEARS = "documents where 1990 + doc_id % 10 between 1993 and 1997"
_STEM_AND = _bm25(["ening", "hation"], "tf0 > 0 and tf1 > 0").replace("from documents)", f"from {_YEARS})").replace(f"{_W} w", f"list_transform({_W}, lambda x: {_stem_sql('x')}) w").replace("x = 'ening'", f"x = '{search.stem_word('ening')}'").replace("x = 'hation'", f"x = '{search.stem_word('hation')}'")


@frame("T1_stemmed_years", f"with {_STEM_AND} select id, score from kw order by score desc, id limit 10")
def stemmed_keyword(t: Tables) -> DataFrame:
    """Any form of the words, in a range of years."""
    docs = _docs(t).withColumn("year", F.col("id") % 10 + 1990)
    return search.keyword_search(docs, "enings hations", years=(1993, 1997), by_stem=True)


@frame("T1_keyword_or_not", f"with {_bm25(['ention', 'hation'], '(tf0 > 0 or tf1 > 0)')}, bad as (select id from d where list_contains(w, 'thanea')) select id, score from kw where id not in (select id from bad) order by score desc, id limit 20")
def keyword_or(t: Tables) -> DataFrame:
    return search.keyword_search(_docs(t), "ention or hation -thanea", k=20)


@frame("T2_boolean_match", f"with d as (select doc_id id, {_W} w from documents) select id from d where list_contains(w, 'thanea') and {_PHRASE}")
def boolean(t: Tables) -> DataFrame:
    return _docs(t).where(search.matches(search.words(F.col("text")), search.parse_query('thanea "of the"'))).select("id")


@frame("T2_per_field_match", "with d as (select doc_id id, list_filter(regexp_split_to_array(lower(string_split(text, chr(10))[1]), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') a, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') b from documents) select id from d where (list_contains(a, 'the') and list_contains(a, 'thanea')) or (list_contains(b, 'ention') and list_contains(b, 'thanea'))")
def per_field(t: Tables) -> DataFrame:
    title = search.words(F.split("text", "\n")[0])
    return _docs(t).where(search.matches(title, search.parse_query("the thanea")) | search.matches(search.words(F.col("text")), search.parse_query("ention thanea"))).select("id")


@frame("T3_phrase_test", f"with d as (select doc_id id, {_W} w from documents) select id, {_PHRASE} as found from d")
def phrase(t: Tables) -> DataFrame:
    return _docs(t).select("id", search.has_phrase(search.words(F.col("text")), ("of", "the")).alias("found"))


@frame("T4_bm25", f"with {_bm25(['thanea'], 'tf0 > 0')} select id, score from kw")
def bm25(t: Tables) -> DataFrame:
    return search.bm25(_docs(t), search.parse_query("thanea"))


@frame("T5_rank_floor", f"with {_bm25(['thanea'], 'tf0 > 0')} select id, score from kw where score >= 2 order by score desc, id limit 1000")
def rank_floor(t: Tables) -> DataFrame:
    return search.keyword_search(_docs(t), "thanea", k=1000, min_rank=2)


@frame("T6_topic_trajectory", f"with d as (select 1990 + doc_id % 10 as year, {_W} w from documents) select year, count(*) as n from d where list_contains(w, 'thanea') group by 1")
def trajectory(t: Tables) -> DataFrame:
    hit = search.matches(search.words(F.col("text")), search.parse_query("thanea"))
    return _docs(t).where(hit).groupBy((F.col("id") % 10 + 1990).alias("year")).agg(F.count(F.lit(1)).alias("n"))


@frame("T7_keyword_net", "select doc_id as id from documents where regexp_matches(text, '(?i)(copyright|license|licence)')")
def net(t: Tables) -> DataFrame:
    return _docs(t).where(T.any_word(F.col("text"), ["copyright", "license", "licence"])).select("id")


@frame("T_token_table", f"with d as (select doc_id id, {_W} w from documents) select id, term, count(*) as tf, max(n) as length from (select id, unnest(w) term, len(w) n from d) group by 1, 2")
def token_table(t: Tables) -> DataFrame:
    return search.tokens(_docs(t))


_COS = "round(list_sum(list_transform(list_zip(e.embedding, q.q), lambda z: z[1]::double * z[2]::double)) / (sqrt(list_sum(list_transform(e.embedding, lambda x: x::double * x::double))) * sqrt(list_sum(list_transform(q.q, lambda x: x::double * x::double)))), 6)"
_SEM = f"sem as (select e.vec_id id, e.label, {_COS} similarity from embeddings e cross join (select embedding q from embeddings where vec_id = 0) q)"


@frame("V1_cosine_knn", f"with {_SEM} select id, similarity from sem order by similarity desc, id limit 10")
def knn(t: Tables) -> DataFrame:
    return search.vector_search(_vectors(t), _first_vector(t))


@frame("V2_filtered_knn", f"with {_SEM} select id, similarity from sem where label is not null and label <> 3 order by similarity desc, id limit 10")
def filtered_knn(t: Tables) -> DataFrame:
    return search.vector_search(_vectors(t), _first_vector(t), where=F.col("label").isNotNull() & (F.col("label") != 3))


@frame("V3_year_range_knn", f"with {_SEM} select id, similarity from sem where label between 2 and 5 order by similarity desc, id limit 10")
def year_knn(t: Tables) -> DataFrame:
    return search.vector_search(_vectors(t), _first_vector(t), where=F.col("label").between(2, 5))


@frame("V4_threshold_match", f"with {_SEM} select id, similarity from sem where similarity >= 0.3 order by similarity desc, id limit 10")
def threshold(t: Tables) -> DataFrame:
    return search.vector_search(_vectors(t), _first_vector(t), floor=0.3)


@frame("V5_ann_limit", f"with {_SEM} select id, similarity from sem where similarity >= 0.1 order by similarity desc, id limit 40")
def ann(t: Tables) -> DataFrame:
    return search.vector_search(_vectors(t), _first_vector(t), k=200, floor=0.1, ann_limit=40)


@frame("V6_prompts", over("select id, 'title: ' || title || ' | text: ' || coalesce(nullif(abstract, ''), 'none') as doc, 'task: search result | query: ' || title as query from papers"))
def prompts(t: Tables) -> DataFrame:
    return view(t, "papers").select("id", search.document_prompt(F.col("title"), F.col("abstract")).alias("doc"), search.query_prompt(F.col("title")).alias("query"))


@frame("V7_dimension_guard", "select cast(len(embedding) as bigint) as size, count(*) as n from embeddings where len(embedding) <> 64 group by 1")
def dimension(t: Tables) -> DataFrame:
    return search.check_dimension(t.embeddings, 64)


@frame("V8_json_vectors", "select vec_id, len(embedding) as n, round(list_sum(embedding)::double, 3) as total from embeddings")
def json_vectors(t: Tables) -> DataFrame:
    back = F.from_json(F.to_json("embedding"), "array<double>")
    return t.embeddings.select("vec_id", F.size(back).cast("long").alias("n"), F.round(F.aggregate(back, F.lit(0.0), lambda a, x: a + x), 3).alias("total"))


_HYB = f"{_AND}, {_SEM}, k as (select id, row_number() over (order by score desc, id) r from (select * from kw order by score desc, id limit 60)), s as (select id, row_number() over (order by similarity desc, id) r from (select * from sem order by similarity desc, id limit 60))"


@frame("H1_hybrid_rrf", f"with {_HYB} select coalesce(k.id, s.id) as id, k.r as keyword_rank, s.r as semantic_rank, round(coalesce(1.0::double / (60 + k.r), 0) + coalesce(1.0::double / (60 + s.r), 0), 8) as score from k full outer join s on s.id = k.id order by score desc, 1 limit 40")
def hybrid(t: Tables) -> DataFrame:
    return search.hybrid_search(_docs(t), _vectors(t), "thanea thanedble", _first_vector(t), k=40)


@frame("H2_recall_audit", f"with st as (select vec_id statement, embedding q from embeddings where vec_id < 4), n as (select e.vec_id id, q.statement, {_COS} similarity from embeddings e cross join st q), top as (select * from n where similarity >= 0.2 qualify row_number() over (partition by statement order by similarity desc, id) <= 40), f as (select * from top qualify row_number() over (partition by id order by statement) = 1) select id, similarity, statement from f where id not in (select vec_id from embeddings where vec_id % 2 = 0)")
def recall(t: Tables) -> DataFrame:
    statements = t.embeddings.where("vec_id < 4").select(F.col("vec_id").alias("statement"), F.col("embedding").alias("q"))
    return search.recall_audit(_vectors(t), statements, t.embeddings.where("vec_id % 2 = 0").select(F.col("vec_id").alias("id")), floor=0.2)


@frame("H3_semantic_only", f"with {_HYB} select id, r as semantic_rank from s where id not in (select id from k)")
def semantic_only(t: Tables) -> DataFrame:
    sem = search.ranked(search.vector_search(_vectors(t), _first_vector(t), k=60), "similarity", "semantic_rank")
    return sem.join(search.keyword_search(_docs(t), "thanea thanedble", k=60).select("id"), "id", "left_anti")


_TRI = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''), lambda w: list_transform(generate_series(1, length(w) + 1), lambda i: substring('  ' || w || ' ', i, 3)))))"


@frame("Z1_fuzzy_names", f"with n as (select s_suppkey id, s_name name, {_TRI.format(x='s_name')} g, {_TRI.format(x=repr('Supplier#00000042'))} h from supplier) select id, name, round(len(list_intersect(g, h)) / len(list_distinct(list_concat(g, h)))::double, 6) as similarity from n where len(list_intersect(g, h)) > 0 order by 3 desc, id limit 20")
def fuzzy(t: Tables) -> DataFrame:
    return search.name_search(t.supplier, "Supplier#00000042", id_col="s_suppkey", name_col="s_name")


@frame("Z2_institution_search", over("select t.id, t.year, ta.institution from talks t join talk_authors ta on ta.paper_id = t.id where ta.institution ilike '%univ 2%' and t.year between 2010 and 2020 order by t.year desc, t.id, ta.institution limit 20"))
def institutions(t: Tables) -> DataFrame:
    found = view(t, "talk_authors").where(F.col("institution").ilike("%univ 2%")).join(view(t, "talks").where("year between 2010 and 2020"), F.col("paper_id") == F.col("id"))
    return found.select("id", "year", "institution").orderBy(F.desc("year"), "id", "institution").limit(20)


@frame("Z3_autocomplete", "select p_name as name, count(*) as n from part where starts_with(lower(p_name), 'sm') group by 1 order by 2 desc, 1 limit 10")
def complete(t: Tables) -> DataFrame:
    return search.autocomplete(t.part, "SM", name_col="p_name")


@frame("Z4_embedding_batch", "select doc_id as id from documents where doc_id not in (select vec_id from embeddings) order by 1 limit 100")
def embedding_batch(t: Tables) -> DataFrame:
    return incremental.pending(t.documents.select(F.col("doc_id").alias("id")), t.embeddings.select(F.col("vec_id").alias("id")), ["id"]).orderBy("id").limit(100)


@frame("J14_join_search_result", f"with {_AND} select x.id, x.score, doc.source from (select * from kw order by score desc, id limit 10) x join documents doc on doc.doc_id = x.id")
def joined_search(t: Tables) -> DataFrame:
    found = search.keyword_search(_docs(t), "thanea thanedble")
    return found.join(t.documents.select(F.col("doc_id").alias("id"), "source"), "id").select("id", "score", "source")


@frame("J16_best_candidate", "with c as (select q.p_partkey id, c.p_partkey candidate, round(1 - levenshtein(q.p_type, c.p_type) / greatest(length(q.p_type), length(c.p_type))::double, 6) sim from part q join part c on c.p_name = q.p_name and c.p_partkey <> q.p_partkey where abs(q.p_size - c.p_size) <= 5) select id, candidate, sim from c qualify row_number() over (partition by id order by sim desc, candidate) = 1")
def candidates(t: Tables) -> DataFrame:
    parts = t.part.select(F.col("p_partkey").alias("id"), "p_name", "p_type", "p_size")
    return linkage.registry_search(parts, parts.withColumnRenamed("id", "candidate"), same=["p_name"], band="p_size", width=5, text="p_type", sim=_rounded_sim, k=1)


# Patches, checks and routing.


def _names(t: Tables) -> tuple[DataFrame, quality.Patch]:
    table = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    rows = table.where("id % 6 = 0").select("id", F.when(F.col("id") % 12 == 0, F.lit("gone")).otherwise(F.col("name")).alias("old"), F.concat("name", F.lit("*")).alias("new"))
    return table, quality.Patch("id", "name", rows)


@frame("D1_compare_and_set", "select s_suppkey as id, case when s_suppkey % 6 = 0 and s_suppkey % 12 <> 0 then s_name || '*' else s_name end as name from supplier")
def compare_and_set(t: Tables) -> DataFrame:
    table, patch = _names(t)
    return patch.apply(table)


@frame("D2_delete_by_keys", over("select paper_id, author_id, position from paper_authors where (paper_id, author_id) not in (select paper_id, author_id from paper_authors where position = 7)"))
def delete_keys(t: Tables) -> DataFrame:
    links = view(t, "paper_authors").select("paper_id", "author_id", "position")
    return quality.delete(links, links.where("position = 7").select("paper_id", "author_id"))


@frame("D3_promote_flag", "with l as (select distinct on (l_orderkey, l_suppkey) l_orderkey paper, l_suppkey author, l_returnflag = 'A' c from lineitem order by l_orderkey, l_suppkey, l_returnflag), m as (select paper, min(author) keep, max(author) dropped from l group by 1 having count(*) > 1) select l.paper, l.author, l.c or coalesce(x.c, false) as corresponding from l left join m on m.paper = l.paper left join l x on x.paper = m.paper and x.author = m.dropped and l.author = m.keep where m.paper is null or l.author <> m.dropped")
def promote(t: Tables) -> DataFrame:
    links = t.lineitem.groupBy(F.col("l_orderkey").alias("paper"), F.col("l_suppkey").alias("author")).agg(F.min("l_returnflag").alias("f")).select("paper", "author", (F.col("f") == "A").alias("corresponding"))
    merges = links.groupBy("paper").agg(F.min("author").alias("keep"), F.max("author").alias("drop"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return quality.merge_credits(links, merges)


@frame("D4_preflight", "select s_suppkey as id, 'changed_meanwhile' as reason from supplier where s_suppkey % 12 = 0")
def preflight(t: Tables) -> DataFrame:
    table, patch = _names(t)
    return patch.preflight(table)


@frame("D5_postcondition", over("select count(*) as lost from (select paper_id from paper_authors where is_corresponding group by 1) a where not exists (select 1 from paper_authors b where b.paper_id = a.paper_id and b.is_corresponding and b.position <> 7)"))
def postcondition(t: Tables) -> DataFrame:
    links = view(t, "paper_authors").where("is_corresponding")
    return links.select("paper_id").distinct().join(links.where("position <> 7").select("paper_id"), "paper_id", "left_anti").agg(F.count(F.lit(1)).alias("lost"))


@frame("D6_delta", "select count(*) as changed, count(*) filter (where s_suppkey % 12 <> 0) as applied from supplier where s_suppkey % 6 = 0")
def delta(t: Tables) -> DataFrame:
    table, patch = _names(t)
    after = patch.apply(table)
    applied = quality.difference(table, after).where("side = 'left'").agg(F.count(F.lit(1)).alias("applied"))
    return patch.rows.agg(F.count(F.lit(1)).alias("changed")).crossJoin(applied)


@frame("D7_archive", "select s_suppkey as id, s_name as name from supplier where s_suppkey % 6 = 0")
def archive(t: Tables) -> DataFrame:
    table, patch = _names(t)
    return patch.archive(table)


@frame("D8_round_trip", "select s_suppkey as id, s_name as name, 'left' as side from supplier where false")
def round_trip(t: Tables) -> DataFrame:
    table, patch = _names(t)
    good = quality.Patch("id", "name", patch.rows.where("old <> 'gone'"))
    return quality.difference(table, good.inverse().apply(good.apply(table)))


def _proposals(t: Tables) -> DataFrame:
    p = view(t, "papers")
    return p.where("doi like '10.%'").select((F.col("id") + 1).alias("id"), F.upper("doi").alias("new_doi"), "title")


@frame("D9_collisions", over("select p.id + 1 as id, upper(p.doi) as new_doi, p.id as owner, 'duplicate_of_existing_row' as reason from papers p where p.doi like '10.%'"))
def collide(t: Tables) -> DataFrame:
    live = view(t, "papers").select("id", F.col("doi").alias("new_doi"), "title")
    return quality.collisions(_proposals(t), live, key="id", value="new_doi", sim=T.levenshtein_sim(F.col("title"), F.col("owner_title"))).select("id", "new_doi", "owner", "reason")


@frame("D10_in_patch_unique", over("with p as (select id, split_part(doi, '/', 1) v from papers where doi is not null) select id, v, count(*) over w > 1 as held, case when count(*) over w > 1 then case when id = min(id) over w then max(id) over w else min(id) over w end end as sibling from p window w as (partition by v)"))
def unique_in_patch(t: Tables) -> DataFrame:
    p = view(t, "papers").where("doi is not null").select("id", F.split_part("doi", F.lit("/"), F.lit(1)).alias("v"))
    return quality.unique_or_held(p, "id", "v")


@frame("D11_dry_run", "select s_suppkey as id, s_name as name from supplier")
def dry_run(t: Tables) -> DataFrame:
    table, patch = _names(t)
    patch.apply(table)
    return table


@frame("D12_drift_gate", over("select document_type as kind, count(*) as n from papers group by 1"))
def drift(t: Tables) -> DataFrame:
    return view(t, "papers").groupBy(F.col("document_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


SPEC = {"target": ["2165-0993"], "source": ["0045-3102"], "words": ["asia", "pacific"], "moving": ["10.1080"], "forbidden": ["J147"]}


def _records(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 6
    issn = F.when(k == 0, F.array(F.lit("0045-3102"))).when(k == 1, F.array().cast("array<string>")).when(k == 2, F.array(F.lit("9999-9999"))).otherwise(F.array(F.lit("2165-0993")))
    doi = F.when(k == 4, F.concat(F.lit("10.1093/"), "p_partkey")).otherwise(F.concat(F.lit("10.1080/"), "p_partkey"))
    return t.part.select(F.col("p_partkey").alias("id"), doi.alias("doi"), issn.alias("issns"), F.when(k == 3, F.lit("Other Journal")).otherwise(F.lit("Asia Pacific Journal")).alias("container"))


@frame("D13_routing", "select p_partkey as id, case when p_partkey % 6 = 4 then '10.1093' else '10.1080' end as signal, case p_partkey % 6 when 0 then 'stay' when 1 then 'skip' when 2 then 'other' when 3 then 'reject' when 4 then 'reject' else 'move' end as route from part")
def routing(t: Tables) -> DataFrame:
    return quality.route(_records(t), SPEC).select("id", "signal", "route")


@frame("D14_premises", "select count(*) filter (where p_partkey % 6 = 5) as moving, count(*) filter (where p_partkey % 6 = 0) as staying, 0::bigint as both from part")
def premises(t: Tables) -> DataFrame:
    r = quality.route(_records(t), SPEC)
    both = F.count_if(F.arrays_overlap("issns", F.array(F.lit("2165-0993"))) & F.arrays_overlap("issns", F.array(F.lit("0045-3102"))))
    return r.agg(F.count_if(F.col("route") == "move").alias("moving"), F.count_if(F.col("route") == "stay").alias("staying"), F.coalesce(both, F.lit(0)).alias("both"))


@frame("D15_single_cluster", "select p_partkey % 6 = 5 as moves, count(*) as n from part group by 1")
def cluster(t: Tables) -> DataFrame:
    return quality.route(_records(t), SPEC).groupBy((F.col("route") == "move").alias("moves")).agg(F.count(F.lit(1)).alias("n"))


@frame("D16_eras", over("with s as (select journal_id j, case when id % 10 < 6 then 'A|B' when id % 10 < 8 then 'C' else 'B|D' end g, publication_year y from papers), e as (select j, g, count(*) n, min(y) f, max(y) l from s group by 1, 2 having count(*) >= 3), r as (select *, row_number() over (partition by j order by n desc, g) rn from e) select x.j as journal, x.g as issns, case when x.g = 'B|D' and m.g = 'A|B' or x.g = 'A|B' and m.g = 'B|D' then 'same_journal_variant_deposit' when (case when x.f >= m.f then x.l else m.l end) <= (case when x.f >= m.f then m.l else x.l end) then 'contamination' when (case when x.f >= m.f then x.f else m.f end) >= (case when x.f >= m.f then m.l else x.l end) - 2 then 'rename' else 'contamination' end as kind from r x join r m on m.j = x.j and m.rn = 1 where x.rn > 1"))
def era_kinds(t: Tables) -> DataFrame:
    k = F.col("id") % 10
    issns = F.when(k < 6, F.array(F.lit("B"), F.lit("A"))).when(k < 8, F.array(F.lit("C"))).otherwise(F.array(F.lit("D"), F.lit("B")))
    samples = view(t, "papers").select(F.col("journal_id").alias("journal"), issns.alias("issns"), F.col("publication_year").alias("year"))
    return linkage.eras(samples).select("journal", F.array_join("issns", "|").alias("issns"), "kind")


@frame("D18_tier_ladder", over("select id, case when doi is null then 'no_rule_match' when doi like 'oai:%' and id % 2 = 0 then 'recovered' when doi like 'oai:%' then 'candidate_not_in_crossref' else 'no_rule_match' end as verdict, case when doi like 'oai:%' and id % 2 = 0 then 'A' else 'C' end as tier from papers"))
def ladder(t: Tables) -> DataFrame:
    p = view(t, "papers").select("id", "doi", "title")
    made = T.oai_to_doi(F.col("doi"), "^oai:.*jssw-([0-9]+)$", "10.5555/JSSW.")
    registry = p.where("doi like 'oai:%' and id % 2 = 0").select(F.concat(F.lit("10.5555/jssw."), F.col("id").cast("string")).alias("doi"), "title")
    return linkage.rule_arm(p, registry, candidate=made, sim=F.when(F.col("title") == F.col("registry_title"), 1.0).otherwise(0.0)).select("id", "verdict", "tier")


@frame("D19_correction_report", over("select p.id, p.research_method as current, '2-HIGH' as proposed from papers p where p.publication_year = 1996 and p.research_method <> '2-HIGH' and p.research_method not in ('1-URGENT', '5-LOW')"))
def corrections(t: Tables) -> DataFrame:
    found = view(t, "papers").where("publication_year = 1996 and research_method <> '2-HIGH'").select("id", F.col("research_method").alias("current"), F.lit("2-HIGH").alias("proposed"))
    allowed = t.spark.createDataFrame([("1-URGENT", "2-HIGH"), ("5-LOW", "2-HIGH")], "current string, proposed string")
    return found.join(F.broadcast(allowed), ["current", "proposed"], "left_anti").select("id", "current", "proposed")


@frame("D20_column_verdict", "select p_partkey as id, case when p_size % 4 = 0 then 'title_mismatch' when p_size % 4 = 1 then 'journal_mismatch' when p_size % 4 = 2 then 'title_weak' else 'confirmed' end as verdict from part")
def verdicts(t: Tables) -> DataFrame:
    k = F.col("p_size") % 4
    sim = F.when(k == 0, 0.5).when(k == 2, 0.8).otherwise(0.95)
    return t.part.select(F.col("p_partkey").alias("id"), quality.column_verdict(sim, F.when(k == 1, "mismatch").otherwise("match")).alias("verdict"))


_BASE = "k as (select id, journal_id j, split_part(doi, '/', 1) p, id % 17 = 0 dig from papers where doi is not null), c as (select j, p, count(*) n, sum(count(*)) over (partition by j) total from k group by 1, 2), b as (select j, p from c where total >= 20 and n >= 0.05 * total)"


@frame("D21_audit", over(f"with {_BASE} select k.id, coalesce(nullif(concat_ws('|', case when k.j in (select j from b) and not exists (select 1 from b where b.j = k.j and b.p = k.p) then 'foreign_prefix' end, case when dig then 'digits_conflict' end), ''), '') as reasons from k"))
def audits(t: Tables) -> DataFrame:
    k = view(t, "papers").where("doi is not null").select("id", F.col("journal_id").alias("journal"), F.split_part("doi", F.lit("/"), F.lit(1)).alias("prefix"))
    found = quality.audit(k, quality.prefix_baseline(k), digits=F.col("id") % 17 == 0, overlap=F.lit(1.0), both=F.lit(True), container=F.lit(False))
    return found.select("id", F.array_join("reasons", "|").alias("reasons"))


# Linkage.


#: Surnames and given names that varied spellings are made of; both engines put them together.
_FAMILIES = "Booth|van den Berg|O'Neil|Smith-Jones|Cronjé|Al Gharaibeh|St John|de la Cruz|Lee|Müller|ibn Khalid"
_GIVENS = "Ann|A.|Bo|Ann Kay|B.|A.B.|Jean-Paul|K. Ann|Zoë"


def _spelled(key: str, table: str) -> str:
    """A query (id, name) of names in several orders and spellings, the same text for both engines."""
    f = f"split_part('{_FAMILIES.replace(chr(39), chr(39) * 2)}', '|', cast({key} % 11 as int) + 1)"
    g = f"split_part('{_GIVENS}', '|', cast({key} % 9 as int) + 1)"
    forms = (f"concat({f}, ', ', {g})", f"concat({g}, ' ', {f})", f"concat({f}, ' ', left({g}, 1), '.')", f"concat(upper({f}), ',  ', {g}, ' ')", f"concat({f}, ' ', left({g}, 1), '. J.')", f, f"concat({g}, ', ', {f}, ', 3rd')")
    return f"select {key} as id, case cast({key} % 7 as int) " + " ".join(f"when {i} then {x}" for i, x in enumerate(forms)) + f" end as name from {table}"


def _names_of(t: Tables, key: str, table: str) -> DataFrame:
    t.views(only=table)
    text = _spelled(key, table).replace("\\", "\\\\").replace("O''Neil", "O\\'Neil")
    return t.spark.sql(text)


_PLAIN = "trim(regexp_replace(regexp_replace(strip_accents(lower(name)), '[^a-z,\\s''-]', ' ', 'g'), '\\s+', ' ', 'g'))"
_LAST = f"^(?:(.*?) )??((?:(?:{'|'.join(PARTICLES)}) )*\\S+)$"
_READ = (
    f"select id, name, trim(case when contains(x, ',') then split_part(x, ',', 1) when regexp_matches(x, '{INITIALS}') then regexp_extract(x, '{INITIALS}', 1) else regexp_extract(x, '{_LAST}', 2) end) surname, "
    f"trim(case when contains(x, ',') then substr(x, position(',' in x) + 1) when regexp_matches(x, '{INITIALS}') then regexp_extract(x, '{INITIALS}', 2) else regexp_extract(x, '{_LAST}', 1) end) given from (select id, name, {_PLAIN} x from n)"
)


@frame("L1_parse_name", f"with n as ({_spelled('c_custkey', 'customer')}), r as ({_READ}) select id, surname, regexp_replace(given, '\\s+', ' ', 'g') as given from r where surname <> ''")
def parse_names(t: Tables) -> DataFrame:
    found = _names_of(t, "c_custkey", "customer").select("id", parsed(F.col("name")).alias("p")).where("p is not null")
    return found.select("id", "p.surname", F.array_join("p.given", " ").alias("given"))


def _parsed(t: Tables) -> DataFrame:
    """Credits with varied spellings of a few names."""
    k = F.col("l_suppkey") % 5
    given = F.element_at(F.array(*map(F.lit, ["Ann", "A.", "Bo", "Ann Kay", "B."])), (k + 1).cast("int"))
    return t.lineitem.select(F.col("l_orderkey").alias("paper_id"), F.col("l_suppkey").alias("author_id"), F.concat(F.lit("Smith, "), given).alias("name")).distinct()


@frame("L3_group_credits")
def credit_groups(t: Tables) -> DataFrame:
    """First-fit groups depend on order; SQL can't express them."""
    return linkage.grouped_credits(_parsed(t))


@frame("L4_merge_gates", "select p_partkey as id, case when p_partkey % 8 = 0 or p_partkey % 8 = 1 then 'registry_unconfirmed' when p_partkey % 8 = 2 then 'fewer_than_two_parsed' when p_partkey % 8 = 3 then 'no_group' when p_partkey % 8 = 4 then 'registry_lists_surname_twice' when p_partkey % 8 = 5 then 'surname_is_a_given_name' when p_partkey % 8 = 6 then 'bare_surname_with_two_initials' end as refused from part")
def gates(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 8
    g = t.part.select(
        F.col("p_partkey").alias("id"), (k != 0).alias("found"), F.when(k == 1, 0.5).otherwise(0.95).alias("sim"), F.when(k == 2, 1).otherwise(2).alias("parsed"), F.when(k == 3, 1).otherwise(2).alias("size"),
        F.when(k == 4, 2).when(k == 5, 0).otherwise(1).alias("registry_same_surname"), (k == 5).alias("surname_is_given"), F.when(k == 6, 2).otherwise(0).alias("bare_initials"), F.lit(False).alias("repeat"),
    )
    return linkage.merge_gates(g).select("id", "refused")


@frame("L5_post_merge_audit", over("with a as (select paper_id, count(*) n from paper_authors group by 1), r as (select paper_id, count(distinct author_id) n from paper_authors group by 1) select count(*) filter (where a.n = r.n) as agree, count(*) filter (where a.n > r.n) as over, count(*) filter (where a.n < r.n) as under from a join r using (paper_id)"))
def post_merge(t: Tables) -> DataFrame:
    n = view(t, "paper_authors").groupBy("paper_id").agg(F.count(F.lit(1)).alias("a"), F.count_distinct("author_id").alias("r"))
    return n.agg(F.count_if(F.expr("a = r")).alias("agree"), F.count_if(F.expr("a > r")).alias("over"), F.count_if(F.expr("a < r")).alias("under"))


#: Names with every kind of trouble, and with what only looks like it.
_ODD_NAMES = (
    "Smith7, John|Chan, Wing-tai,|SCHUERMA.JR|Gottlieb|THYER, BA|Booth, Tim|Zuraini J.@.O.|see a@b.org|http://x.org/y|Smith, J<i>x</i>|Smith (|Lee|et al.|Various|[Anonymous]|The Editors|Editorial Board| Smith, J|Smith,  J|"
    "Coldon, Lawrence, 3rd|Smith, 6th|Filip CoussÃ©e|Bergmark Å.|Müller &amp; Co|n/a|Ng, X.|Li|O'Neil|Jean-Paul|LEE S.|Smith, J. -|UN Staff|staff|Anon."
)
_N_ODD = _ODD_NAMES.count("|") + 1
_ODD = f"select s_suppkey as id, split_part('{_ODD_NAMES.replace(chr(39), chr(39) * 2)}', '|', cast(s_suppkey % {_N_ODD} as int) + 1) as name from supplier"


def _census() -> str:
    """The categories in order, by patterns."""
    one = "not regexp_matches(trim(name), '\\s')"
    tests = (
        ("empty", "trim(name) = ''"), ("placeholder_convention", f"regexp_matches(name, '(?i)^\\s*\\[?({NO_NAME})\\]?\\s*$')"), ("corruption_mojibake", "contains(name, 'Ã©')"), ("corruption_entity", "regexp_matches(name, '(?i)&[a-z]+;|<[^>]+>')"),
        ("corruption_email_url", "regexp_matches(name, '(?i)https?://|www[.]|@[a-z]+[.]')"), ("corruption_digits", "regexp_matches(regexp_replace(name, '\\b(1st|2rd|3rd|4th|5th)\\b', '', 'g'), '[0-9]')"),
        ("corruption_whitespace", "regexp_matches(name, '\\s{2,}')"), ("corruption_trailing_punct", "regexp_matches(name, '[,;:(\\[{/-]\\s*$')"), ("format_wos_truncated", "regexp_matches(trim(name), '^[A-Z]{8}[.][A-Z]{1,3}$')"),
        ("structural_fragment_short", f"{one} and length(trim(name)) < 4"), ("structural_bare_token", f"{one} and regexp_matches(trim(name), '^[A-Za-zÀ-ÿ''-]+$')"), ("format_all_caps_legacy", f"not ({one}) and name = upper(name) and regexp_matches(name, '[A-Z]{{2}}')"),
    )
    return "case " + " ".join(f"when {test} then '{kind}'" for kind, test in tests) + " end"


@frame("L6_name_census", f"with n as ({_ODD}) select id, {_census()} as category from n")
def census(t: Tables) -> DataFrame:
    t.views(only="supplier")
    return t.spark.sql(_ODD.replace("O''Neil", "O\\'Neil")).select("id", quality_of(F.col("name")).alias("category"))


@frame("L7_name_repair", "select s_suppkey as id, case s_suppkey % 5 when 0 then 'Filip Coussée' when 1 then 'Eybalin, Dominique' when 2 then 'Chan, Wing-tai' when 3 then 'Darlene Chalmers' end as new, case s_suppkey % 5 when 0 then 'mojibake' when 1 then 'footnote_digit' when 2 then 'trailing_comma' when 3 then 'doubled_space' end as kind from supplier")
def repairs(t: Tables) -> DataFrame:
    from quillstone.functions.names import repair

    name = F.element_at(F.array(*map(F.lit, ["Filip CoussÃ©e", "Eybalin1, Dominique", "Chan, Wing-tai,", "Darlene  Chalmers", "Coldon, Lawrence, 3rd"])), (F.col("s_suppkey") % 5 + 1).cast("int"))
    return t.supplier.select(F.col("s_suppkey").alias("id"), repair(name).alias("r")).select("id", "r.new", "r.kind")


@frame("L8_truncated_names", "select s_suppkey as id, case s_suppkey % 3 when 0 then 'ambiguous' when 1 then 'ok' else 'no_match' end as verdict, case when s_suppkey % 3 = 1 then 'Hokenstad, Merl C.' end as name from supplier")
def truncated(t: Tables) -> DataFrame:
    from quillstone.functions.names import match_truncated_udf

    name = F.element_at(F.array(*map(F.lit, ["SCHUERMA.JR", "HOKENSTA.MC", "ROSENFEL.HM"])), (F.col("s_suppkey") % 3 + 1).cast("int"))
    registry = F.array(*[F.struct(F.lit(a).alias("family"), F.lit(b).alias("given")) for a, b in (("Schuerman", "John R."), ("Hokenstad", "Merl C."), ("Schuermann", "Alice"))])
    return t.supplier.select(F.col("s_suppkey").alias("id"), match_truncated_udf(name, registry).alias("m")).select("id", "m.verdict", "m.name")


@frame("L9_initials_only", "select s_suppkey as id, case s_suppkey % 4 when 0 then 'THYER' when 1 then 'Islam' when 2 then 'Gonzalez' end as surname, case s_suppkey % 4 when 0 then 'BA' when 1 then 'MR' when 2 then 'JE' end as initials from supplier")
def initials(t: Tables) -> DataFrame:
    from quillstone.functions.names import parse_initials_udf

    name = F.element_at(F.array(*map(F.lit, ["THYER, BA", "Islam M.R.", "J. E. Gonzalez", "Thyer, Bruce A."])), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return t.supplier.select(F.col("s_suppkey").alias("id"), parse_initials_udf(name).alias("p")).select("id", "p.surname", F.when(F.col("p").isNotNull(), F.array_join("p.initials", "")).alias("initials"))


@frame("L10_judge_paper", "select s_suppkey as id, case s_suppkey % 3 when 0 then 'ok' when 1 then 'refuse' else 'skip' end as verdict, case s_suppkey % 3 when 0 then 'Thyer, Bruce A.' when 1 then 'initials_conflict' else 'no_crossref' end as what from supplier")
def judged(t: Tables) -> DataFrame:
    from quillstone.functions.names import judge_paper_udf

    k = F.col("s_suppkey") % 3
    registry = F.array(F.struct(F.lit("Thyer").alias("family"), F.lit("Bruce A.").alias("given")))
    known = F.when(k == 2, F.slice(registry, F.lit(1), F.lit(0))).otherwise(registry)
    ours = F.when(k == 1, F.array(F.lit("A"), F.lit("B"))).otherwise(F.array(F.lit("B"), F.lit("A")))
    return t.supplier.select(F.col("s_suppkey").alias("id"), judge_paper_udf(F.lit("Thyer"), ours, F.array(F.lit("THYER, BA")), known).alias("j")).select("id", "j.verdict", "j.what")


@frame("L11_unanimity_vote", "with v as (select l_suppkey a, min(case when l_tax > 0.075 then l_orderkey end) refused, count(distinct case when l_tax <= 0.075 and l_discount < 0.05 then l_returnflag end) forms, max(case when l_tax <= 0.075 and l_discount < 0.05 then l_returnflag end) form from lineitem group by 1) select a as author, case when refused is not null then 'refused' when forms = 0 then 'no_votes' when forms > 1 then 'papers_disagree' else 'enriched' end as verdict, case when refused is null and forms = 1 then form end as form from v")
def unanimous(t: Tables) -> DataFrame:
    votes = t.lineitem.select(F.col("l_suppkey").alias("author"), (F.col("l_tax") > 0.075).alias("veto"), F.when((F.col("l_tax") <= 0.075) & (F.col("l_discount") < 0.05), F.col("l_returnflag")).alias("form"))
    g = votes.groupBy("author").agg(F.bool_or("veto").alias("veto"), F.count_distinct("form").alias("forms"), F.max("form").alias("form"))
    verdict = F.when(F.col("veto"), "refused").when(F.col("forms") == 0, "no_votes").when(F.col("forms") > 1, "papers_disagree").otherwise("enriched")
    return g.select("author", verdict.alias("verdict"), F.when(verdict == "enriched", F.col("form")).alias("form"))


@frame("L12_surname_keys", "with m as (select distinct 'Name' || chr(97 + (p_size % 5)::int) || ', ' || case p_partkey % 4 when 0 then 'A.' when 1 then 'Anna' when 2 then case when p_size % 5 < 3 then 'Anna' else 'Ada' end else 'B.' end mention from part) select mention, case when mention like '%, A%' and right(split_part(mention, ',', 1), 1) in ('d', 'e') then case when mention like '%Anna' then lower(split_part(mention, ',', 1)) || '|a|anna' when mention like '%Ada' then lower(split_part(mention, ',', 1)) || '|a|ada' end else lower(split_part(mention, ',', 1)) || '|' || lower(substring(split_part(mention, ', ', 2), 1, 1)) end as person from m")
def surnames(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 4
    given = F.when(k == 0, "A.").when(k == 1, "Anna").when(k == 2, F.when(F.col("p_size") % 5 < 3, "Anna").otherwise("Ada")).otherwise("B.")
    mentions = t.part.select(F.concat(F.lit("Name"), F.char((F.col("p_size") % 5 + 97).cast("long")), F.lit(", "), given).alias("mention")).distinct()
    return linkage.resolve_surnames(mentions)


_KEY = "lower(regexp_replace(text, '[^a-zA-Z0-9]', '', 'g'))"


@frame("L13_title_year_dedup", f"with k as (select doc_id, lang, {_KEY} k from documents), r as (select *, row_number() over (partition by k, lang order by doc_id) rn from k) select r.doc_id as id, coalesce((select string_agg(x.doc_id::varchar, '; ' order by x.doc_id) from r x where x.k = r.k and x.lang = r.lang and x.rn > 1), '') as duplicate_ids from r where rn = 1")
def dedup_titles(t: Tables) -> DataFrame:
    rows = t.documents.select(F.col("doc_id").alias("id"), F.md5(T.alnum_key(F.col("text")).cast("binary")).alias("k"), "lang")
    return linkage.resolve_duplicates(rows, group=[F.col("k"), F.col("lang")], best=[]).select("id", "duplicate_ids")


@frame("L13_best_of_group", over("""
    with c as (select p.id, p.title || ' ' || p.journal_id t, p.publication_year y, p.doi is not null d, length(coalesce(p.abstract, '')) a, (select count(*) from paper_authors l where l.paper_id = p.id) n from papers p),
    r as (select *, first_value(id) over (partition by t, y order by d desc, a desc, n desc, id) best from c)
    select best as id, coalesce(string_agg(cast(id as varchar), '; ' order by id) filter (where id <> best), '') as duplicate_ids from r group by t, y, best"""))
def best_of_group(t: Tables) -> DataFrame:
    """Of records with one title and year the one with an identifier, the longest abstract and the most authors."""
    authors = view(t, "paper_authors").groupBy(F.col("paper_id").alias("id")).agg(F.count(F.lit(1)).alias("authors"))
    papers = view(t, "papers").join(authors, "id", "left")
    title = F.concat_ws(" ", "title", F.col("journal_id").cast("string"))
    best = [F.col("doi").isNotNull(), F.char_length(F.coalesce("abstract", F.lit(""))), F.coalesce("authors", F.lit(0))]
    return linkage.resolve_duplicates(papers, group=[title, F.col("publication_year")], best=best).select("id", "duplicate_ids")


@frame("L15_search_arm", "with p as (select p_partkey id, p_partkey % 7 k from part) select id, case k when 0 then 'no_candidate' when 1 then 'weak_title' when 2 then 'digits_conflict' when 3 then 'rejected_wrong_journal' when 4 then 'ambiguous_candidates' when 5 then 'authors_disagree' else 'recovered' end as verdict, case when k = 6 then 'B' else 'C' end as tier from p")
def search_arm(t: Tables) -> DataFrame:
    k = F.col("id") % 7
    base = t.part.select(F.col("p_partkey").alias("id"))
    two = base.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("nth"))
    pairs = two.where(~((k == 0) & (F.col("nth") == 2))).select(
        "id",
        F.when(k != 0, F.col("nth")).alias("candidate"),
        F.when(k == 1, 0.5).when(F.col("nth") == 1, 0.96).when(k == 4, 0.95).otherwise(0.91).alias("sim"),
        F.when(k == 5, 0.0).when((k == 4) & (F.col("nth") == 2), 0.6).otherwise(0.5).alias("author"),
        (k == 2).alias("digits"),
        F.lit(True).alias("both_named"),
        (~k.isin(0, 1, 2, 3)).alias("journal_ok"),
    )
    return linkage.best_candidate(pairs, sim="sim", author="author", eligible=F.col("journal_ok")).select("id", "verdict", "tier")


@frame("L16_canonical_mapping", "select c_custkey as id, case when c_mktsegment in ('FURNITURE', 'HOUSEHOLD') then 'HOME' else c_mktsegment end as segment from customer")
def mapping(t: Tables) -> DataFrame:
    m = t.spark.createDataFrame([("FURNITURE", "HOME"), ("HOUSEHOLD", "HOME")], "raw string, canonical string")
    return linkage.apply_mapping(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")), m, "segment")


# Graph.

_MEMBERS = "m as (select distinct l_orderkey item, l_partkey member from lineitem)"
_EDGES = "e as (select x.member a, y.member b, count(*) w from m x join m y on x.item = y.item and x.member < y.member group by 1, 2)"
_KEPT = "b as (select member from m group by 1 having count(*) >= 2), mb as (select * from m where member in (select member from b)), e0 as (select x.member a, y.member b, count(*) w from mb x join mb y on x.item = y.item and x.member < y.member group by 1, 2)"


def _core_sql(least: int, rounds: int) -> str:
    """The core by a fixed number of rounds that is more than the data need."""
    parts = [f"{_MEMBERS}, {_KEPT}"]
    for i in range(rounds):
        parts.append(f"k{i} as materialized (select v from (select a v from e{i} union all select b from e{i}) group by 1 having count(*) >= {least}), e{i + 1} as materialized (select * from e{i} where a in (select v from k{i}) and b in (select v from k{i}))")
    return "with " + ", ".join(parts)


#: Rows of members a task: some two pairs each.
_TASK_ROWS = 1 << 19


def _members(t: Tables) -> DataFrame:
    """Items are dealt out before they are counted, to as many tasks as their number asks for: what a task holds doesn't grow with the table."""
    rows = t.lineitem.select(F.col("l_orderkey").alias("item"), F.col("l_partkey").alias("member"))
    tasks = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-t.lineitem.count() // _TASK_ROWS))
    return rows.repartition(tasks, "item").distinct()


@frame("G1_edges", f"with {_MEMBERS}, {_EDGES} select a, b, w from e")
def edge_list(t: Tables) -> DataFrame:
    return graph.edges(_members(t))


@frame("G2_node_threshold", f"with {_MEMBERS} select member, count(*) as n from m group by 1 having count(*) >= 2")
def busy_nodes(t: Tables) -> DataFrame:
    return graph.busy(_members(t), 2)


@frame("G3_k_core", f"{_core_sql(3, 16)} select a, b, w from e16")
def core(t: Tables) -> DataFrame:
    return graph.network(_members(t), min_items=2, min_links=3)


@frame("G4_node_attributes", f"{_core_sql(3, 16)}, v as (select a v from e16 union select b from e16), l as (select o_orderkey item, case when o_orderkey % 3 = 0 then 'E' when o_orderkey % 3 = 1 then 'R' else 'S' end label from orders) select m.member, count(*) as n, count(*) filter (where label = 'E') as e, count(*) filter (where label = 'R') as r, count(label) as total, round((count(*) filter (where label = 'E') + count(*) filter (where label = 'R') / 2.0) / count(label)::double, 6) as score from m join l using (item) where m.member in (select v from v) group by 1")
def node_attributes(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 3
    labels = t.orders.select(F.col("o_orderkey").alias("item"), F.when(k == 0, "E").when(k == 1, "R").otherwise("S").alias("label"))
    members = _members(t)
    return graph.nodes(members, graph.network(members, min_items=2, min_links=3), labels)


@frame("G5_threshold_subgraph", f"with {_MEMBERS}, {_KEPT} select a, b, w from e0")
def threshold_graph(t: Tables) -> DataFrame:
    members = _members(t)
    return graph.edges(members.join(graph.busy(members, 2).select("member"), "member", "left_semi"))


@frame("G7_index_remap", f"with {_MEMBERS}, {_KEPT}, c as (select member, count(*) n from mb where member in (select a from e0 union select b from e0) group by 1), i as (select member, row_number() over (order by n desc, member) - 1 i from c) select x.i as s, y.i as t, w from e0 join i x on x.member = a join i y on y.member = b")
def remap(t: Tables) -> DataFrame:
    members = _members(t)
    kept = members.join(graph.busy(members, 2).select("member"), "member", "left_semi")
    links = graph.edges(kept)
    counts = kept.join(graph.degrees(links).select("member"), "member", "left_semi").groupBy("member").agg(F.count(F.lit(1)).alias("n"))
    return graph.remapped(links, graph.numbered(counts))


# Incremental work.


@frame("I1_resumable_batch", "select doc_id as id, length(text)::bigint as n from documents")
def resumable(t: Tables) -> DataFrame:
    todo = t.documents.select(F.col("doc_id").alias("id"), "text")
    work = lambda rows: rows.select("id", F.char_length("text").cast("long").alias("n"))
    done = work(todo.where("id % 2 = 0"))
    return incremental.resume(todo, done, work, ["id"])


@frame("I2_version_guard", "select doc_id as id, 'v2' as version from documents")
def versioned(t: Tables) -> DataFrame:
    todo = t.documents.select(F.col("doc_id").alias("id"))
    done = todo.where("id % 2 = 0").withColumn("version", F.when(F.col("id") % 4 == 0, "v1").otherwise("v2"))
    return incremental.resume(todo, done, lambda rows: rows, ["id"], version="v2")


@frame("I3_negative_cache", "select n_nationkey as key, case when n_nationkey % 3 = 0 then n_name end as value from nation")
def negative_cache(t: Tables) -> DataFrame:
    keys = t.nation.select(F.col("n_nationkey").alias("key"))
    cache = t.nation.where("n_nationkey < 5").select(F.col("n_nationkey").alias("key"), F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).alias("value"))
    found = t.nation.where("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value"))
    return incremental.lookup(keys, cache, lambda missing: found.join(missing, "key", "left_semi"))[1]


# What is left of the inventory.


@frame("S8_checkpoint_guard", "select doc_id as id, 'v2' as version from documents")
def checkpoint_guard(t: Tables) -> DataFrame:
    """Results of an older version count as not done, and are made again."""
    todo = t.documents.select(F.col("doc_id").alias("id"))
    old = todo.where("id % 3 = 0").withColumn("version", F.lit("v1"))
    return incremental.resume(todo, old, lambda rows: rows, ["id"], version="v2")


@frame("S19_patch_with_checks", "select s_suppkey as id, case when s_suppkey % 6 = 0 and s_suppkey % 12 <> 0 then s_name || '*' else s_name end as name from supplier")
def checked_patch(t: Tables) -> DataFrame:
    """Changes that would not apply are held back before, and none is left after."""
    table, patch = _names(t)
    sound = quality.Patch("id", "name", patch.rows.join(patch.preflight(table), "id", "left_anti"))
    return sound.apply(table)


@frame("W3_ranked_arms", f"with {_HYB} select 'keyword' as arm, id, r as rank from k union all select 'semantic', id, r from s")
def ranked_arms(t: Tables) -> DataFrame:
    kw = search.ranked(search.keyword_search(_docs(t), "thanea thanedble", k=60), "score", "rank").select(F.lit("keyword").alias("arm"), "id", "rank")
    return kw.unionAll(search.ranked(search.vector_search(_vectors(t), _first_vector(t), k=60), "similarity", "rank").select(F.lit("semantic"), "id", "rank"))


@frame("X12_surname_sets", over("select paper_id, string_agg(distinct 'surname' || chr((97 + author_id % 7)::int), '|' order by 'surname' || chr((97 + author_id % 7)::int)) as surnames from paper_authors group by 1"))
def surname_sets(t: Tables) -> DataFrame:
    name = F.concat(F.lit("Surname"), F.char((F.col("author_id") % 7 + 97).cast("long")), F.when(F.col("author_id") % 2 == 0, F.lit(", Ann")).otherwise(F.lit(" A.")))
    bylines = view(t, "paper_authors").groupBy("paper_id").agg(F.array_join(F.collect_list(name), "; ").alias("authors"))
    return bylines.select("paper_id", F.array_join(T.surnames(F.col("authors")), "|").alias("surnames"))


@frame("X19_first_elements", "select n_nationkey as id, case when n_nationkey % 3 > 0 then n_name end as title, case when n_nationkey % 3 = 2 then 'Sub' end as subtitle from nation")
def first_elements(t: Tables) -> DataFrame:
    """First elements of nested arrays that may be empty."""
    none = F.array().cast("array<string>")
    k = F.col("n_nationkey") % 3
    item = F.struct(F.when(k > 0, F.array("n_name")).otherwise(none).alias("title"), F.when(k == 2, F.array(F.lit("Sub"), F.lit("More"))).otherwise(none).alias("subtitle"))
    back = F.from_json(F.to_json(item), "title array<string>, subtitle array<string>")
    return t.nation.select(F.col("n_nationkey").alias("id"), F.get(back["title"], F.lit(0)).alias("title"), F.get(back["subtitle"], F.lit(0)).alias("subtitle"))


@frame("X26_screening_codes", "select doc_id, quality = 1 or toxic = 0 as valid, case when quality = 1 and toxic = 0 then 'empirical/quantitative' when quality = 1 then 'empirical/qualitative' when toxic = 0 then 'not_relevant' end as code from labels")
def screening(t: Tables) -> DataFrame:
    relevant = F.col("quality") == 1
    evidence = F.when(relevant, "empirical")
    method = F.when(relevant, F.when(F.col("toxic") == 0, "quantitative").otherwise("qualitative")).when(F.col("toxic") == 1, "quantitative")
    valid = T.valid_screening(relevant, evidence, method)
    return t.labels.select("doc_id", valid.alias("valid"), F.when(valid, T.expand_screening(relevant, evidence, method)).alias("code"))


_DIFFERENT = "len(list_filter(list_zip(string_split(a.given, ' '), string_split(b.given, ' ')), lambda z: z[1] <> '' and z[2] <> '' and not (case when length(z[1]) = 1 or length(z[2]) = 1 then left(z[1], 1) = left(z[2], 1) else z[1] = z[2] end)))"


@frame("L2_compatible_names", f"with n as ({_spelled('s_suppkey', 'supplier')}), r as ({_READ}) select a.id as a, b.id as b from r a join r b on a.surname = b.surname and a.id < b.id where a.surname <> '' and {_DIFFERENT} = 0")
def compatible_pairs(t: Tables) -> DataFrame:
    """Names are parsed once each, before they meet."""
    return linkage.name_pairs(_names_of(t, "s_suppkey", "supplier").select("id", parsed(F.col("name")).alias("p")))
