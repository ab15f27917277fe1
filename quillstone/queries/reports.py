"""Reports and compound questions as compositions of DataFrame steps, each table read once where that is enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.operators.graph import pairs_within
from quillstone.queries.base import frame, over, view
from quillstone.sources.tables import Tables

SINCE = 1997


def tally(df: DataFrame, *by: str, into: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(into))


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def leader(df: DataFrame, rank: Column, *tie: str) -> DataFrame:
    """The row with the highest rank, ties to the first."""
    return df.orderBy(rank.desc(), *[F.asc_nulls_last(c) for c in tie]).limit(1)


def names_in_order(links: DataFrame, authors: DataFrame, mark: str) -> DataFrame:
    """(paper_id, names): the authors of each paper of links, by position and then id."""
    named = links.join(authors.select(F.col("id").alias("author_id"), "name"), "author_id")
    ordered = named.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("position", "author_id", "name"))).alias("byline"))
    return ordered.select("paper_id", F.array_join("byline.name", mark).alias("names"))


@frame("Q1_author_publication_stats", over("""
    with links as (select author_id, paper_id, max(case when position = 1 then 1 else 0 end) first_one, max(case when is_corresponding then 1 else 0 end) corr from paper_authors group by author_id, paper_id),
    sums as (select author_id, count(*) n, sum(first_one) f, sum(corr) c from links group by author_id)
    select id, name, orcid, coalesce(n, 0) publication_count, cast(coalesce(f, 0) as bigint) first_author_count, cast(coalesce(c, 0) as bigint) corresponding_author_count from authors left join sums on author_id = id"""))
def author_stats(t: Tables) -> DataFrame:
    """A link counts once for its author and paper before anything else is counted."""
    links = view(t, "paper_authors").groupBy("author_id", "paper_id").agg(F.bool_or(F.col("position") == 1).alias("first"), F.bool_or("is_corresponding").alias("corresponding"))
    sums = links.groupBy(F.col("author_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.count_if("first").alias("f"), F.count_if("corresponding").alias("c"))
    zero = lambda c, into: F.coalesce(c, F.lit(0)).alias(into)
    return view(t, "authors").join(sums, "id", "left").select("id", "name", "orcid", zero("n", "publication_count"), zero("f", "first_author_count"), zero("c", "corresponding_author_count"))


@frame("Q3_highly_cited_papers", over("""
    with cited as (select * from papers where times_cited > 400000),
    bylines as (select l.paper_id, string_agg(w.name, ', ' order by l.position, w.id) as byline from paper_authors l, authors w where w.id = l.author_id and l.paper_id in (select id from cited) group by l.paper_id)
    select c.id, c.title, c.times_cited, (select j.name from journals j where j.id = c.journal_id) as journal_name, b.byline as author_names from cited c left join bylines b on b.paper_id = c.id"""))
def highly_cited(t: Tables) -> DataFrame:
    """Only links of the papers asked for meet the authors."""
    cited = view(t, "papers").where("times_cited > 400000").select("id", "title", "times_cited", "journal_id")
    links = view(t, "paper_authors").join(cited.select(F.col("id").alias("paper_id")), "paper_id", "left_semi")
    bylines = names_in_order(links, view(t, "authors"), ", ").select(F.col("paper_id").alias("id"), F.col("names").alias("author_names"))
    journals = view(t, "journals").select(F.col("id").alias("journal_id"), F.col("name").alias("journal_name"))
    return cited.join(journals, "journal_id", "left").join(bylines, "id", "left").select("id", "title", "times_cited", "journal_name", "author_names")


def _together(t: Tables) -> DataFrame:
    return tally(pairs_within(view(t, "author_affiliations"), "paper_id", "organization_id"), "a", "b")


_TOGETHER = """
    with sets as (select paper_id, list_sort(list(distinct organization_id)) orgs from author_affiliations group by paper_id),
    firsts as (select paper_id, orgs, unnest(orgs) a from sets), both_ as (select a, unnest(list_filter(orgs, lambda x: x > a)) b from firsts), counted as (select a, b, count(*) n from both_ group by a, b)"""


@frame("Q4_organization_collaborations", over(_TOGETHER + " select a org1_id, (select name from organizations where id = a) org1_name, b org2_id, (select name from organizations where id = b) org2_name, n collaboration_count from counted"))
def collaborations(t: Tables) -> DataFrame:
    org = lambda c, into: view(t, "organizations").select(F.col("id").alias(c), F.col("name").alias(into))
    named = _together(t).join(org("a", "org1_name"), "a").join(org("b", "org2_name"), "b")
    return named.select(F.col("a").alias("org1_id"), "org1_name", F.col("b").alias("org2_id"), "org2_name", F.col("n").alias("collaboration_count"))


@frame("J5_theta_self_join", over(_TOGETHER + " select a as org1, b as org2, n from counted"))
def shared_papers(t: Tables) -> DataFrame:
    return _together(t).select(F.col("a").alias("org1"), F.col("b").alias("org2"), "n")


@frame("Q9_health_journal", over("""
    with by_paper as (select paper_id, count(*) n, min(position) least from paper_authors group by paper_id), slots as (select 1 from paper_authors group by paper_id, position having count(*) > 1)
    select 'papers_without_authors' as block, count(*) as n from papers where id not in (select paper_id from by_paper)
    union all select 'links_without_paper', cast(coalesce(sum(n), 0) as bigint) from by_paper where paper_id not in (select id from papers)
    union all select 'links_without_author', count(*) from paper_authors where author_id not in (select id from authors)
    union all select 'papers_without_journal', count(*) from papers where journal_id is null or journal_id not in (select id from journals)
    union all select 'duplicate_dois', count(*) from (select 1 from papers where doi is not null group by lower(doi) having count(*) > 1) x
    union all select 'oai_dois', count(*) from papers where starts_with(doi, 'oai:')
    union all select 'no_first_position', count(*) from papers join by_paper on paper_id = id where paper_id not in (select paper_id from paper_authors where position = 1)
    union all select 'duplicate_positions', count(*) from slots
    union all select 'unclassified', count(*) from papers where is_scientific is null
    union all select 'duplicate_author_names', count(*) from (select 1 from authors group by lower(name) having count(*) > 1) z"""))
def journal_health(t: Tables) -> DataFrame:
    """Papers and links meet once; every block that concerns them is a conditional count over that."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    authors = view(t, "authors")
    slots = view(t, "paper_authors").join(authors.select(F.col("id").alias("author_id"), F.lit(True).alias("known")), "author_id", "left").groupBy("paper_id", "position").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("known").isNull()).alias("lost"))
    links = slots.groupBy(F.col("paper_id").alias("id")).agg(F.sum("n").alias("links"), F.sum("lost").alias("lost"), F.count_if(F.col("n") > 1).alias("doubled"), F.bool_or(F.col("position") == 1).alias("first"))
    journals = view(t, "journals").select(F.col("id").alias("journal_id"), F.lit(True).alias("journal"))
    papers = view(t, "papers").select("id", "journal_id", "doi", "is_scientific", F.lit(True).alias("paper")).join(journals, "journal_id", "left")
    both = papers.join(links, "id", "full")
    is_paper = F.col("paper").isNotNull()
    counts = both.agg(
        F.count_if(is_paper & F.col("links").isNull()).alias("papers_without_authors"),
        zero(F.sum(F.when(~is_paper, F.col("links")))).alias("links_without_paper"),
        zero(F.sum("lost")).alias("links_without_author"),
        F.count_if(is_paper & F.col("journal").isNull()).alias("papers_without_journal"),
        F.count_if(F.startswith("doi", F.lit("oai:"))).alias("oai_dois"),
        F.count_if(is_paper & ~F.col("first")).alias("no_first_position"),
        zero(F.sum("doubled")).alias("duplicate_positions"),
        F.count_if(is_paper & F.col("is_scientific").isNull()).alias("unclassified"),
    )
    rows = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("block"), F.col(c).cast("long").alias("n")) for c in counts.columns])))
    twice = lambda df, key, block: tally(df.select(key.alias("k")), "k").agg(F.lit(block).alias("block"), F.count_if(F.col("n") > 1).alias("n"))
    dois = twice(papers.where("doi is not null"), F.lower("doi"), "duplicate_dois")
    return rows.unionByName(dois).unionByName(twice(authors, F.lower("name"), "duplicate_author_names"))


# Compound questions.


@frame("E28_mean_authors", over(f"select round(count(*) / cast(count(distinct paper_id) as double), 2) as mean_authors from paper_authors where paper_id in (select id from papers where publication_year >= {SINCE})"))
def mean_authors(t: Tables) -> DataFrame:
    scope = view(t, "papers").where(F.col("publication_year") >= SINCE).select(F.col("id").alias("paper_id"))
    bylines = tally(view(t, "paper_authors"), "paper_id").join(scope, "paper_id", "left_semi")
    return bylines.agg(F.round(F.avg("n"), 2).alias("mean_authors"))


@frame("E29_first_large_year", over("select year as y from talks group by year having count(*) >= 5 order by year limit 1"))
def first_large_year(t: Tables) -> DataFrame:
    return tally(view(t, "talks"), "year").where("n >= 5").agg(F.min("year").alias("y"))


@frame("E41_share_among_large", over(f"""
    with scope as (select journal_id, is_empirical, research_method from papers where publication_year >= {SINCE}),
    large as (select journal_id from scope group by journal_id having count(*) > 9),
    shares as (select journal_id, avg(case when research_method = '1-URGENT' then 1.0 else 0.0 end) share from scope semi join large using (journal_id) where is_empirical group by journal_id)
    select name from shares join journals on id = journal_id order by share desc, name limit 1"""))
def share_among_large(t: Tables) -> DataFrame:
    """Size and share of a journal come from one pass over its papers."""
    scope = view(t, "papers").where(F.col("publication_year") >= SINCE)
    by_journal = scope.groupBy(F.col("journal_id").alias("id")).agg(F.count(F.lit(1)).alias("size"), F.avg(F.when(F.col("is_empirical"), F.coalesce(F.col("research_method") == "1-URGENT", F.lit(False)).cast("double"))).alias("share"))
    named = by_journal.where("size > 9 and share is not null").join(view(t, "journals").select("id", "name"), "id")
    return leader(named, F.col("share"), "name").select("name")


@frame("E42_many_authors", over(f"select count(*) as n from papers p where publication_year >= {SINCE} and (select count(*) from paper_authors l where l.paper_id = p.id) >= 6"))
def many_authors(t: Tables) -> DataFrame:
    large = tally(view(t, "paper_authors"), "paper_id").where("n >= 6")
    return total(view(t, "papers").where(F.col("publication_year") >= SINCE).join(large, F.col("id") == F.col("paper_id"), "left_semi"))


def in_both_years(df: DataFrame, key: str, year: str, first: int, second: int) -> DataFrame:
    """How many keys occur in both years: one pass, no intersection."""
    seen = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.bool_or(F.col(year) == first).alias("a"), F.bool_or(F.col(year) == second).alias("b"))
    return seen.agg(F.count_if(F.col("a") & F.col("b")).alias("n"))


@frame("E44_both_years", over("select count(*) as n from (select journal_id from papers where publication_year in (1995, 2001) group by journal_id having count(distinct publication_year) = 2) t"))
def journals_in_both(t: Tables) -> DataFrame:
    return in_both_years(view(t, "papers"), "journal_id", "publication_year", 1995, 2001)


def _dated(t: Tables) -> DataFrame:
    """Credits of talks with the talk's year."""
    return view(t, "talk_authors").join(view(t, "talks").select(F.col("id").alias("paper_id"), "year"), "paper_id")


@frame("E45_top_first_author", over("""
    with leads as (select author_id, count(*) k from talk_authors where author_order = 1 and paper_id in (select id from talks where year >= 2010 and year <= 2015) group by author_id)
    select name from speakers s, leads where s.id = author_id order by k desc, name limit 1"""))
def top_first_author(t: Tables) -> DataFrame:
    leads = tally(_dated(t).where((F.col("author_order") == 1) & F.col("year").between(2010, 2015)), "author_id")
    return leader(leads.join(view(t, "speakers").select(F.col("id").alias("author_id"), "name"), "author_id"), F.col("n"), "name").select("name")


@frame("E46_speakers_both_years", over("select count(*) as n from speakers s where exists (select 1 from talk_authors c join talks k on k.id = c.paper_id and k.year = 2005 where c.author_id = s.id) and exists (select 1 from talk_authors c join talks k on k.id = c.paper_id and k.year = 2026 where c.author_id = s.id)"))
def speakers_in_both(t: Tables) -> DataFrame:
    known = view(t, "speakers").select(F.col("id").alias("author_id"))
    return in_both_years(_dated(t).join(known, "author_id", "left_semi"), "author_id", "year", 2005, 2026)


@frame("E47_most_institutions", over("""
    with seats as (select distinct year, institution from talks join talk_authors on paper_id = id and author_order = 1 where institution is not null)
    select year from seats group by year order by count(*) desc, year limit 1"""))
def most_institutions(t: Tables) -> DataFrame:
    seats = _dated(t).where("author_order = 1 and institution is not null").select("year", "institution").distinct()
    return leader(tally(seats, "year"), F.col("n"), "year").select("year")


@frame("E48_talks_many_authors", over("select count(*) as n from (select paper_id from talk_authors group by paper_id having count(*) >= 7) t"))
def talks_with_many_authors(t: Tables) -> DataFrame:
    return total(tally(view(t, "talk_authors"), "paper_id").where("n >= 7"))
