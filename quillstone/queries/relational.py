"""Projections, filters, joins, aggregates, windows, order and sets, as the inventory lists them."""

from __future__ import annotations

from quillstone.queries.base import sql

SCOPE = "publication_year >= 1997"
PCT = "cast(100 as double)"

# Scans that SQL expresses.
sql("S1_guarded_select", lambda d: "select id, publication_year, title from papers where journal_id = 3 order by id limit 1000", cap=1000)
sql("S2_rows_as_dicts", lambda d: f"select {d.agg('concat(cast(id as string), chr(58), name)', ';', 'id')} as rows_text from journals")
sql("S5_page_of_total_order", lambda d: "select id, title from papers order by id limit 50 offset 100")
sql("S11_record_count", lambda d: "select count(*) as records from documents", bare=True)
sql("S14_table_counts", lambda d: " union all ".join(f"select '{t}' as table_name, count(*) as n from {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")), bare=True)

# Projections.
sql("P1_projection_alias", lambda d: "select id as paper, publication_year as year, document_type as kind from papers")
sql("P2_boolean_projection", lambda d: "select id, abstract is not null as has_abstract, doi is null as no_doi from papers")
sql("P3_case_classification", lambda d: "select id, case when doi like 'oai:%' then 'oai' when doi is null then 'none' else 'dc' end as kind from papers")
sql("P4_coalesce_concat", lambda d: "select id, coalesce(title, '') || ' ' || coalesce(abstract, '') as text, title || abstract as null_when_either from papers")
sql("P5_tagged_union", lambda d: "select 'J' as source_database, cast(id as string) as id, doi from papers union all select 'C', cast(id as string), cast(null as string) from talks")

# Predicates.
sql("F1_range", lambda d: "select publication_year, count(*) as n from papers where publication_year between 1996 and 2000 and times_cited >= 1000.5 group by 1")
sql("F2_null_and_boolean", lambda d: "select count(*) as n from papers where is_scientific and not is_empirical and abstract is not null")
sql("F2_three_valued_scope", lambda d: f"select 'in' as part, count(*) as n from papers where {SCOPE} and is_scientific and abstract is not null union all select 'out', count(*) from papers where {SCOPE} and not (is_scientific and abstract is not null)")
sql("F3_ilike", lambda d: "select id, title from papers where title ilike '%URGENT%study 1%'")
sql("F4_like_prefix", lambda d: "select count(*) as n from papers where doi like 'oai:%'")
sql("F5_regex", lambda d: f"select sum(case when {d.matches('doi', '^10[.][0-9]{4,9}/')} then 1 else 0 end) as valid, sum(case when not {d.matches('doi', '^10[.][0-9]{4,9}/')} then 1 else 0 end) as invalid from papers".replace("sum(", "cast(sum(").replace("end)", "end) as bigint)"))
sql("F7_alternation_net", lambda d: f"select doc_id from documents where {d.matches('text', '(?i)(copyright|license|licence)')}", bare=True)
sql("F8_in_lists", lambda d: "select research_method, count(*) as n from papers where journal_id in (1, 2, 3) and research_method not in ('5-LOW', '1-URGENT') group by 1")
sql("F9_tuple_in", lambda d: "select count(*) as n from paper_authors where (paper_id, author_id) in (select paper_id, author_id from author_affiliations where organization_id < 5)")
sql("F10_distinct_from", lambda d: "select t.id, t.author_count, c.n from talks t join (select paper_id, count(*) as n from talk_authors group by 1) c on c.paper_id = t.id where t.author_count + t.id % 2 is distinct from c.n")
sql("F11_conditional_filter", lambda d: "select count(*) as n from papers where case when true then abstract is not null else true end")
sql("F12_optional_range", lambda d: "select count(*) as n from papers where publication_year between coalesce(cast(null as bigint), 1920) and coalesce(1999, 2026)")
sql("F13_pattern_arms", lambda d: f"select id, {d.matches('title', '1-URGENT')} as in_title, coalesce({d.matches('abstract', 'URGENT')}, false) as in_abstract from papers where {d.matches('title', 'URGENT|HIGH')}")

# Joins.
sql("J1_inner_dim", lambda d: "select j.name, count(*) as n from papers p join journals j on j.id = p.journal_id group by 1")
sql("J2_left_outer", lambda d: "select p.id, j.name as journal_name from papers p left join journals j on j.id = p.journal_id and j.publisher is not null")
sql("J3_multiway_bridge", lambda d: f"select p.id, max(j.name) as journal, {d.agg('a.name', ', ', 'pa.position, a.id')} as byline from papers p left join journals j on j.id = p.journal_id left join paper_authors pa on pa.paper_id = p.id left join authors a on a.id = pa.author_id group by p.id")
sql("J4_bridge_chain", lambda d: "select a.name, count(*) as n from paper_authors pa join papers p on p.id = pa.paper_id join authors a on a.id = pa.author_id where p.publication_year = 1998 group by 1")
sql("J6_ego_self_join", lambda d: "select y.author_id as other, count(distinct x.paper_id) as together from paper_authors x join paper_authors y on y.paper_id = x.paper_id and y.author_id <> x.author_id where x.author_id = 7 group by 1")
sql("J7_anti_join", lambda d: "select p.id from papers p where not exists (select 1 from paper_authors pa where pa.paper_id = p.id)")
sql("J8_semi_and_anti", lambda d: "select p.id from papers p where exists (select 1 from paper_authors pa where pa.paper_id = p.id) and not exists (select 1 from paper_authors pa where pa.paper_id = p.id and pa.position = 1)")
sql("J9_orphans", lambda d: "select count(*) as links, count(*) filter (where p.id is null) as orphans from paper_authors pa left join (select * from papers where id % 10 <> 0) p on p.id = pa.paper_id")
sql("J10_one_row_cross", lambda d: "select p.id from papers p cross join (select '1-URGENT' as q) x where p.research_method = x.q and p.publication_year = 1996")
sql("J11_correlated_string_agg", lambda d: f"select p.id, coalesce((select {d.agg('a.name', '; ', 'pa.position, a.id')} from paper_authors pa join authors a on a.id = pa.author_id where pa.paper_id = p.id), '') as authors from papers p")
sql("J12_correlated_having", lambda d: "select j.id, count(*) as n from papers p join journals j on j.id = p.journal_id where p.is_empirical group by j.id having (select count(*) from papers p2 where p2.journal_id = j.id) >= 10")
sql("J13_scalar_subqueries", lambda d: "select (select count(*) from papers) as papers, (select count(*) from authors) as authors, (select count(doi) from papers) as with_doi, (select max(publication_year) from papers) as latest")
sql("J15_folded_lookup", lambda d: "select p.id, x.tag from papers p left join (select upper(doi) as k, 'seen' as tag from papers where id % 9 = 0) x on lower(x.k) = lower(p.doi)")
sql("J17_update_from", lambda d: "select a.id, coalesce(u.name, a.name) as name from authors a left join (select id, concat(name, ' II') as name from authors where id % 4 = 0) u on u.id = a.id")
sql("J18_ego_through_ids", lambda d: "select a.id, a.name, count(distinct pa.paper_id) as n from authors a join paper_authors pa on pa.author_id = a.id where pa.paper_id in (select id from papers where journal_id = 4) group by 1, 2")

# Aggregates.
sql("A1_counts", lambda d: "select research_method, count(*) as n, count(doi) as with_doi from papers group by 1")
sql("A2_count_distinct", lambda d: "select p.publication_year, count(distinct aa.organization_id) as orgs from author_affiliations aa join papers p on p.id = aa.paper_id group by 1")
sql("A3_count_distinct_case", lambda d: "select publication_year, count(distinct case when wos_uid is not null then id end) as wos, count(distinct case when scopus_eid is not null then id end) as scopus from papers group by 1")
sql("A4_filtered_counts", lambda d: "select journal_id, count(*) filter (where is_empirical) as empirical, count(*) filter (where abstract is null) as bare from papers group by 1")
sql("A5_min_max_avg_sum", lambda d: "select publication_year, round(min(times_cited), 2) as least, round(max(times_cited), 2) as most, round(avg(times_cited), 2) as mean, round(sum(times_cited), 2) as total from papers group by 1")
sql("A6_percent", lambda d: f"select publication_year, round({PCT} * count(*) filter (where is_scientific) / count(*), 1) as pct from papers group by 1")
sql("A7_decades", lambda d: f"select {d.div('publication_year', '10')} * 10 as decade, count(*) as n from papers group by 1")
sql("A8_two_levels", lambda d: f"select p.publication_year, round(avg(c.n), 2) as mean_authors, round({PCT} * count(*) filter (where c.n = 1) / count(*), 1) as pct_solo from papers p join (select paper_id, count(*) as n from paper_authors group by 1) c on c.paper_id = p.id group by 1")
sql("A9_having", lambda d: "select author_id, count(*) as n from paper_authors group by 1 having count(*) > 5")
sql("A10_ordered_string_agg", lambda d: f"select paper_id, {d.agg('cast(author_id as string)', ',', 'position, author_id')} as authors from paper_authors group by 1")
sql("A11_group_by_ordinals", lambda d: "select publication_year, research_method, count(*) as n from papers group by 1, 2")
sql("A12_distinct", lambda d: "select distinct research_method, document_type from papers")
sql("A14_array_to_string", lambda d: f"select journal_id, {d.agg('cast(id as string)', '|', 'id')} as evidence from papers group by 1")
sql("A16_nested_counts", lambda d: "select journal_id, count(*) filter (where wos_uid is not null) as wos, count(*) filter (where scopus_eid is not null) as scopus, count(*) filter (where wos_uid is null and scopus_eid is null) as neither from papers group by 1")
sql("A17_share_within", lambda d: f"select publication_year, research_method, round({PCT} * count(*) / sum(count(*)) over (partition by publication_year), 4) as pct from papers group by 1, 2")
sql("A18_named_ranges", lambda d: "select e.era, count(*) as n from papers p join (select 'early' as era, 1990 as lo, 1996 as hi union all select 'middle', 1997, 1999 union all select 'late', 2000, 2010) e on p.publication_year between e.lo and e.hi group by 1")
sql("A19_upper_median", lambda d: f"select method, value as median from (select event_type as method, value, row_number() over (partition by event_type order by value, event_id) as rn, count(*) over (partition by event_type) as n from events) x where rn = {d.div('n', '2')} + 1", bare=True)
sql("A21_null_rates", lambda d: f"select round({PCT} * count(doi) / count(*), 1) as doi, round({PCT} * count(abstract) / count(*), 1) as abstract, round({PCT} * count(wos_uid) / count(*), 1) as wos, round({PCT} * count(is_scientific) / count(*), 1) as scientific from papers")
sql("A22_vocabulary", lambda d: "select p_type as value, count(*) as n from part group by 1 order by 2 desc, 1 limit 25", bare=True)
sql("A23_parity_vector", lambda d: "select count(*) as n, count(distinct journal_id) as journals, min(id) as lo, max(id) as hi, cast(sum(id) as bigint) as total from papers")
sql("A25_agreement", lambda d: f"select source, round({PCT} * count(*) filter (where a.quality = a.toxic) / count(*), 1) as agree, count(*) as n from labels a join documents on documents.doc_id = a.doc_id group by 1", bare=True)
sql("A26_annualised", lambda d: "select publication_year, cast(round(count(*) * cast(12 as double) / 7) as bigint) as full_year from papers group by 1")
sql("A27_dense_axis", lambda d: f"select y.year, coalesce(c.n, 0) as n from (select cast(d as bigint) as year from (select {d.days('1993, 2003')} as d) x) y left join (select publication_year, count(*) as n from papers where research_method = '5-LOW' group by 1) c on c.publication_year = y.year")
sql("A28_other_rollup", lambda d: "with c as (select journal_id, count(*) as n from papers group by 1), r as (select *, row_number() over (order by n desc, journal_id) as rn from c) select case when rn <= 14 then cast(journal_id as string) else 'Other' end as venue, cast(sum(n) as bigint) as n, count(*) as venues from r group by 1")
sql("A29_singletons_top_share", lambda d: f"with c as (select record_key as k, count(*) as n from papers group by 1), r as (select *, row_number() over (order by n desc, k) as rn from c) select count(*) filter (where n = 1) as singletons, round({PCT} * sum(n) filter (where rn <= 10) / sum(n), 2) as top10 from r")
sql("A30_unanimity", lambda d: "select cast(sum(u) as bigint) as unanimous, count(*) as items from (select paper_id, case when count(distinct is_corresponding) = 1 then 1 else 0 end as u from paper_authors group by 1) x")

# Windows.
sql("W1_hash_sample", lambda d: "select journal_id, id from (select journal_id, id, row_number() over (partition by journal_id order by (id * 2654435761) % 1000003, id) as rn from papers) x where rn <= 12")
sql("W2_window_over_aggregate", lambda d: "select journal_id, document_type, count(*) as n, cast(sum(count(*)) over (partition by journal_id) as bigint) as total from papers group by 1, 2")
sql("W4_best_of_group", lambda d: "select record_key, id from (select *, row_number() over (partition by record_key, publication_year order by case when doi is not null then 1 else 0 end desc, length(coalesce(abstract, '')) desc, id) as rn from papers) x where rn = 1")
sql("W5_tie_aware_cut", lambda d: "select record_key, n from (select record_key, n, rank() over (order by n desc) as r from (select record_key, count(*) as n from papers group by 1) c) x where r <= 20")
sql("W6_keep_drop", lambda d: "select paper_id, author_id, position, case when rn = 1 then 'keep' else 'drop' end as fate from (select *, row_number() over (partition by paper_id, author_id order by position, case when is_corresponding then 0 else 1 end) as rn from paper_authors) x")
sql("W7_runner_up_gap", lambda d: "select journal_id, id, round(gap, 2) as gap from (select journal_id, id, row_number() over w as rn, times_cited - lead(times_cited) over w as gap from papers window w as (partition by journal_id order by times_cited desc, id)) x where rn = 1")
sql("W8_first_last_year", lambda d: "select pa.author_id, p.journal_id, min(p.publication_year) as first_year, max(p.publication_year) as last_year from paper_authors pa join papers p on p.id = pa.paper_id group by 1, 2")
sql("W9_display_numbers", lambda d: "select name, n, row_number() over (order by n desc, name) - 1 as idx from (select a.name, count(*) as n from paper_authors pa join authors a on a.id = pa.author_id group by 1) x")
sql("W10_rare_clusters", lambda d: f"select journal_id, band, n, total from (select journal_id, cast(floor(times_cited / 100000) as bigint) as band, count(*) as n, cast(sum(count(*)) over (partition by journal_id) as bigint) as total from papers group by 1, 2) x where n >= 10 and n < 0.18 * total")

# Order and sets.
sql("O1_many_keys", lambda d: "select publication_year, title, id from papers order by publication_year desc, title, id limit 300")
sql("O2_top_k", lambda d: "select id, times_cited from papers order by times_cited desc, id limit 25")
sql("O3_order_by_hidden_aggregate", lambda d: "select publication_year from papers group by 1 order by count(*) desc, publication_year limit 1")
sql("O4_seeded_order", lambda d: "select id from papers order by md5(concat(cast(id as string), 'seed-20260802')), id limit 40")
sql("O6_null_order", lambda d: "select id, doi from papers order by doi asc nulls last, id limit 100")
sql("O6_null_order_desc", lambda d: "select id, doi from papers order by doi desc nulls first, id limit 100")
sql("U1_intersect", lambda d: "select record_key from papers where publication_year = 1995 intersect select record_key from papers where publication_year = 2001")
sql("U2_union_all", lambda d: "select 'no_position_1' as problem, count(*) as n from papers p where not exists (select 1 from paper_authors a where a.paper_id = p.id and a.position = 1) union all select 'duplicate_position', count(*) from (select paper_id, position from paper_authors group by 1, 2 having count(*) > 1) x")
sql("U4_set_difference", lambda d: "select id from papers where publication_year = 1997 except select paper_id from paper_authors where position = 1")
sql("U5_except_both_ways", lambda d: "with a as (select id, doi from papers), b as (select id, case when id % 101 = 0 then 'changed' else doi end as doi from papers) select 'lost' as side, * from (select * from a except select * from b) x union all select 'new', * from (select * from b except select * from a) y")
sql("U6_partition_check", lambda d: "select count(*) filter (where keep) as kept, count(*) filter (where not keep) as queued, count(*) as census from (select coalesce(is_scientific, false) as keep from papers) x")
sql("U8_cross_corpus_union", lambda d: "select 'J' as corpus, cast(id as string) as id, title, publication_year as year from papers union all select 'C', cast(id as string), title, year from talks")

# Scalar functions that SQL expresses alike.
sql("X1_case_substring_length", lambda d: "select id, lower(title) as low, upper(title) as up, substring(title, 1, 12) as head, cast(length(title) as bigint) as n from papers")
sql("X2_split_part", lambda d: "select id, split_part(doi, '/', 1) as prefix from papers where doi is not null")
sql("X3_regex_group", lambda d: f"select id, {d.extract('doi', '^10[.]([0-9]+)/')} as registrant from papers")
sql("X4_regex_replace", lambda d: f"select id, lower({d.replace_all('title', '[^a-zA-Z0-9]', '')}) as k from papers")
sql("X5_dedup_key", lambda d: f"select lower({d.replace_all('title', '[^a-zA-Z0-9]', '')}) || '|' || cast(publication_year as string) as k, count(*) as n from papers where is_scientific group by 1 having count(*) > 1")
sql("X16_md5", lambda d: "select id, md5(cast(id as string)) as h, (id * 2654435761) % 1000003 as m from papers")
sql("X17_clamp", lambda d: "select id, least(greatest(times_cited / 500000, 0.1), 0.9) as x, round(times_cited, 1) as y from papers")
sql("X18_casts", lambda d: "select id, cast(id as string) as s, cast(cast(id as string) as bigint) as i, cast(id as double) as f from papers")
sql("X23_publisher_stem", lambda d: f"select id, case when doi like 'oai:%' then 'oai' when {d.matches('doi', '^10[.]10[0-2]')} then {d.extract('doi', '^(10[.]10[0-9]+)/')} else split_part(doi, '/', 1) end as stem from papers where doi is not null")
sql("X27_group_collapse", lambda d: "select id, case when is_scientific is null then 'unknown' when not is_scientific then 'excluded' when is_empirical then 'empirical' else 'conceptual' end as grp from papers")

# Views and reports.
sql("Q2_database_summary", lambda d: "select p.*, a.n as total_authors, o.n as total_organizations, j.n as total_journals from (select count(*) as total_papers, count(doi) as papers_with_doi, count(wos_uid) as wos_papers, count(scopus_eid) as scopus_papers, round(avg(times_cited), 2) as avg_citations, round(max(times_cited), 2) as max_citations, min(publication_year) as earliest_year, max(publication_year) as latest_year from papers) p cross join (select count(*) as n from authors) a cross join (select count(*) as n from organizations) o cross join (select count(*) as n from journals) j")
sql("Q5_papers_with_journals", lambda d: "select p.id, p.title, p.doi, p.publication_year, j.name as journal_name, j.publisher as journal_publisher from papers p left join journals j on j.id = p.journal_id")
sql("Q6_publication_trends", lambda d: "select publication_year, count(*) as paper_count, count(distinct journal_id) as journal_count, count(distinct case when wos_uid is not null then id end) as wos_count, count(distinct case when scopus_eid is not null then id end) as scopus_count, round(avg(times_cited), 2) as avg_citations, round(max(times_cited), 2) as max_citations from papers where publication_year is not null group by 1 order by 1 desc")
sql("Q7_scoped_views", lambda d: f"select 'papers' as part, count(*) as n from papers where {SCOPE} union all select 'supplement', count(*) from papers where not ({SCOPE}) or publication_year is null union all select 'talks', count(*) from talks")
sql("Q8_paper_export", lambda d: f"select t.id, t.title, t.year, t.methodology, {d.agg('s.name', '|', 'ta.author_order, s.id')} as canonical_authors, {d.agg('ta.institution', '|', 'ta.author_order, s.id')} as canonical_institutions from talks t left join talk_authors ta on ta.paper_id = t.id left join speakers s on s.id = ta.author_id group by 1, 2, 3, 4")
sql("Q10_health_conference", lambda d: """
select 'author_count_differs' as block, count(*) as n from talks t join (select paper_id, count(*) as n from talk_authors group by 1) c on c.paper_id = t.id where t.author_count is distinct from c.n
union all select 'no_abstract', count(*) from talks where abstract is null
union all select 'no_methodology', count(*) from talks where methodology is null
union all select 'no_institution', count(*) from talk_authors where institution is null
union all select 'speakers_without_talk', count(*) from speakers s where not exists (select 1 from talk_authors a where a.author_id = s.id)
""")
sql("Q11_journal_attribution", lambda d: "select j.name as journal, x.stem, x.n as records_with_stem, x.total as journal_total from (select journal_id, split_part(doi, '/', 1) as stem, count(*) as n, cast(sum(count(*)) over (partition by journal_id) as bigint) as total from papers where doi is not null group by 1, 2) x join journals j on j.id = x.journal_id where x.n >= 10 and x.n < 0.18 * x.total order by x.n desc, j.name, x.stem limit 25")
sql("Q12_enrichment_freshness", lambda d: "select count(*) as stale_enrichment_rows from (select id, case when id % 13 = 0 then concat(name, '?') else name end as name_as_published from authors) e join authors a on a.id = e.id where a.name <> e.name_as_published")
sql("Q13_trajectory_record", lambda d: "select p.id, p.publication_year, p.title, min(pa.position) as position from paper_authors pa join papers p on p.id = pa.paper_id where pa.author_id = 7 group by 1, 2, 3")
sql("Q13_trajectory_activity", lambda d: "select p.publication_year, count(distinct p.id) as papers, count(distinct p.id) filter (where pa.position = 1) as first_authored from paper_authors pa join papers p on p.id = pa.paper_id where pa.author_id = 7 group by 1")
sql("Q13_trajectory_collaborators", lambda d: "select a.name, count(distinct y.paper_id) as together, min(p.publication_year) as since, max(p.publication_year) as until from paper_authors x join paper_authors y on y.paper_id = x.paper_id and y.author_id <> x.author_id join authors a on a.id = y.author_id join papers p on p.id = x.paper_id where x.author_id = 7 group by a.id, a.name")
sql("Q13_trajectory_institutions", lambda d: "select t.year, ta.institution, count(*) as n from talk_authors ta join talks t on t.id = ta.paper_id where ta.author_id = 7 and ta.institution is not null group by 1, 2")
sql("Q14_international", lambda d: "select country, count(distinct paper_id) as presentations from talk_authors where country not in ('USA', 'United States') group by 1 order by 2 desc, 1 limit 20")
sql("Q15_top_organizations", lambda d: "select o.name, count(distinct aa.paper_id) as papers from author_affiliations aa join organizations o on o.id = aa.organization_id group by o.id, o.name order by 2 desc, 1 limit 20")
sql("Q16_supplement_by_decade", lambda d: f"select {d.div('publication_year', '10')} * 10 as decade, count(*) as n, round({PCT} * count(abstract) / count(*), 1) as pct_with_abstract from papers where publication_year < 2001 group by 1")
sql("Q18_corpus_statistics", lambda d: f"with c as (select *, case when wos_uid is not null then 'wos' when scopus_eid is not null then 'scopus' else 'other' end as src from papers where is_scientific) select publication_year, src, count(*) as n, round({PCT} * count(*) / sum(count(*)) over (partition by publication_year), 1) as pct, count(distinct journal_id) as outlets from c group by 1, 2")
sql("Q19_outcome_statistics", lambda d: f"select case when l.quality is null then 'unscreened' when l.toxic = 1 then 'flagged' when l.quality = 1 then 'relevant' else 'other' end as grp, d.lang, count(*) as n, round({PCT} * count(*) / sum(count(*)) over (partition by d.lang), 2) as share from documents d left join labels l on l.doc_id = d.doc_id group by 1, 2", bare=True)
sql("Q20_documented_claims", lambda d: "select claim, actual, expected, case when actual = expected then 'ok' else 'FAIL' end as verdict from (select 'nations' as claim, count(*) as actual, 25 as expected from nation union all select 'regions', count(*), 5 from region union all select 'regions wrong', count(*), 6 from region) x", bare=True)
