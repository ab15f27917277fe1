"""Registration of queries, and the collections that they run over.

A query written in SQL is one text with the few places where Spark and DuckDB differ spelled by a
dialect; Spark's runs through the guarded SQL entry. A query written with DataFrames brings SQL of its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quillstone.plans.sql import run_sql
from quillstone.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Dialect:
    spark: bool

    def agg(self, value: str, mark: str, order: str) -> str:
        """Ordered string aggregation."""
        return f"listagg({value}, '{mark}') within group (order by {order})" if self.spark else f"string_agg({value}, '{mark}' order by {order})"

    def matches(self, text: str, pattern: str) -> str:
        """Whether a pattern without backslashes occurs."""
        return f"{text} rlike '{pattern}'" if self.spark else f"regexp_matches({text}, '{pattern}')"

    def div(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def replace_all(self, text: str, pattern: str, by: str) -> str:
        return f"regexp_replace({text}, '{pattern}', '{by}'" + (")" if self.spark else ", 'g')")

    def extract(self, text: str, pattern: str) -> str:
        """The first group, or null."""
        return f"nullif(regexp_extract({text}, '{pattern}', 1), '')"

    def days(self, text: str) -> str:
        return f"explode(sequence({text}))" if self.spark else f"unnest(generate_series({text}))"


SPARK, DUCK = Dialect(True), Dialect(False)


#: The two collections over the driver's tables, by name. Nullable columns come from nullif.
#: Journal schema: papers, journals, authors, paper_authors, organizations, author_affiliations.
#: Conference schema: talks, talk_authors, speakers.
COLLECTIONS = {
    "papers": """
        select o_orderkey as id, cast(year(o_orderdate) as bigint) as publication_year, o_orderpriority as research_method,
               (nullif(o_orderstatus, 'P') = 'F') as is_scientific, (o_orderkey % 3 = 0) as is_empirical,
               case when o_orderkey % 4 <> 0 then o_orderpriority end as abstract,
               case when o_orderkey % 7 = 0 then null when o_orderkey % 11 = 0 then concat('oai:host/jssw-', cast(o_orderkey as string))
                    else concat('10.', cast(1000 + o_custkey % 50 as string), '/a.', cast(o_orderkey as string)) end as doi,
               concat(o_orderpriority, ' study ', cast(o_custkey as string)) as title, o_orderstatus as document_type,
               case when o_orderkey % 3 = 1 then 'wos' || cast(o_orderkey as string) end as wos_uid,
               case when o_orderkey % 5 < 2 then 'sc' || cast(o_orderkey as string) end as scopus_eid,
               o_custkey % 25 as journal_id, o_totalprice as times_cited, o_custkey as record_key
        from orders
    """,
    "journals": """
        select cast(n_nationkey as bigint) as id, n_name as name, case when n_nationkey % 5 = 0 then null else concat('Press ', cast(n_regionkey as string)) end as publisher from nation
    """,
    "authors": """
        select s_suppkey as id, s_name as name, case when s_suppkey % 3 = 0 then s_name end as orcid, cast(s_nationkey as bigint) as organization_id from supplier
    """,
    "paper_authors": """
        select l_orderkey as paper_id, l_suppkey as author_id, cast(l_linenumber as bigint) as position, (l_returnflag = 'A') as is_corresponding from lineitem
    """,
    "organizations": """
        select cast(n_nationkey as bigint) as id, concat('Org ', n_name) as name from nation
    """,
    "author_affiliations": """
        select distinct l_orderkey as paper_id, l_suppkey as author_id, cast(s_nationkey as bigint) as organization_id from lineitem join supplier on s_suppkey = l_suppkey
    """,
    "talks": """
        select event_id as id, cast(2005 + event_id % 22 as bigint) as year, event_type as format, nullif(event_type, 'error') as methodology,
               concat(event_type, ' by ', cast(user_id as string)) as title, case when event_id % 6 <> 0 then props end as abstract,
               cast(1 + event_id % 8 as bigint) as author_count
        from events
    """,
    "talk_authors": """
        select event_id as paper_id, cast(1 as bigint) as author_order, user_id as author_id,
               nullif(concat('Univ ', cast(user_id % 30 as string)), 'Univ 7') as institution, case when user_id % 10 < 7 then 'USA' else concat('Country ', cast(user_id % 10 as string)) end as country from events
        union all
        select event_id, cast(2 + k as bigint), (user_id + 17 * k) % 150, concat('Univ ', cast((user_id + k) % 30 as string)), 'USA'
        from events join (select cast(n_nationkey as bigint) as k from nation where n_nationkey < 7) x on k < event_id % 8
    """,
    "speakers": """
        select user_id as id, concat('Speaker ', cast(user_id as string)) as name, count(*) as total_papers from events group by user_id
    """,
}


def with_collections(body: str) -> str:
    """SQL over the collections: those that it names stand before it."""
    body = body.strip()
    used = [n for n in COLLECTIONS if re.search(rf"\b{n}\b", body)]
    if not used:
        return body
    head = ",\n".join(f"{n} as ({COLLECTIONS[n].strip()})" for n in used)
    return f"with {head}, {body[5:]}" if body.startswith("with ") else f"with {head}\n{body}"


def sql(name: str, make: Callable[[Dialect], str], *, bare: bool = False, cap: int | None = None) -> None:
    """Register a query given as SQL over the collections (``bare``: over the tables alone)."""

    def text(d: Dialect) -> str:
        return make(d).strip() if bare else with_collections(make(d))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        Tables(spark, sf_dir).views(only=text(SPARK))
        return run_sql(spark, text(SPARK), cap=cap)

    QUERIES[name] = run
    ORACLES[name] = text(DUCK)


def frame(name: str, oracle: str | None = None) -> Callable:
    """Register a function of (tables) that returns a DataFrame, with SQL for the same rows."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def view(t: Tables, name: str) -> DataFrame:
    """One of the collections as a DataFrame."""
    text = with_collections(f"select * from {name}")
    t.views(only=text)
    return t.spark.sql(text)


#: DuckDB SQL over the collections.
over = with_collections
