"""The evaluation corpus: questions of one clause or two over the two collections; ``reports`` has the compound ones."""

from __future__ import annotations

from quillstone.queries.base import sql

_SIMPLE = {
    "E01_all_papers": "select count(*) as n from papers",
    "E02_supplement": "select count(*) as n from papers where publication_year < 1997",
    "E03_journals": "select count(*) as n from journals",
    "E04_in_journal": "select count(*) as n from papers p join journals j on j.id = p.journal_id where j.name = 'NATION_3'",
    "E05_talks_in_year": "select count(*) as n from talks where year = 2024",
    "E06_all_talks": "select count(*) as n from talks",
    "E07_speakers": "select count(*) as n from speakers",
    "E08_talks_first_year": "select count(*) as n from talks where year = 2005",
    "E09_methods": "select distinct research_method from papers where research_method is not null",
    "E10_method_count": "select count(*) as n from papers where research_method = '2-HIGH'",
    "E11_other_method": "select count(*) as n from papers where research_method = '5-LOW'",
    "E12_conceptual": "select count(*) as n from papers where is_scientific and not is_empirical",
    "E13_talk_methods": "select distinct methodology from talks where methodology is not null",
    "E14_talks_by_method": "select count(*) as n from talks where methodology = 'click'",
    "E15_talks_other_method": "select count(*) as n from talks where methodology = 'view'",
    "E16_formats": "select count(distinct format) as n from talks where format is not null",
    "E17_top_journal": "select j.name, count(*) as n from papers p join journals j on j.id = p.journal_id where p.publication_year >= 1997 group by 1 order by 2 desc, 1 limit 1",
    "E18_journal_since": "select count(*) as n from papers p join journals j on j.id = p.journal_id where j.name = 'NATION_8' and p.publication_year >= 1997",
    "E19_orgs_in_year": "select count(distinct aa.organization_id) as n from author_affiliations aa join papers p on p.id = aa.paper_id where p.publication_year = 1999",
    "E20_links_in_year": "select count(*) as n from paper_authors pa join papers p on p.id = pa.paper_id where p.publication_year = 1998",
    "E21_top_institution": "select pa.institution, count(*) as n from talk_authors pa join talks p on p.id = pa.paper_id where pa.author_order = 1 and p.year between 2020 and 2026 group by 1 order by 2 desc, 1 nulls last limit 1",
    "E22_speaker_talks": "select count(*) as n from talk_authors where author_id = 42",
    "E23_speakers_in_year": "select count(distinct pa.author_id) as n from talk_authors pa join talks p on p.id = pa.paper_id where p.year = 2015",
    "E24_first_at_institution": "select count(*) as n from talk_authors where author_order = 1 and institution = 'Univ 12'",
    "E25_best_year": "select publication_year from papers where publication_year between 1996 and 2000 and is_scientific and abstract is not null group by 1 order by count(*) desc, 1 limit 1",
    "E26_empirical_in_year": "select count(*) as n from papers where publication_year = 1998 and is_scientific and abstract is not null and is_empirical",
    "E27_range": "select count(*) as n from papers where publication_year between 1996 and 1999 and is_scientific and abstract is not null",
    "E30_largest_year": "select year from talks group by year order by count(*) desc, year limit 1",
    "E31_year_and_method": "select count(*) as n from talks where year = 2010 and methodology = 'purchase'",
    "E32_best_year_of_method": "select year from talks where methodology = 'signup' group by year order by count(*) desc, year limit 1",
    "E43_best_year_of_research": "select publication_year from papers where publication_year between 1995 and 2000 and research_method = '3-MEDIUM' group by 1 order by count(*) desc, 1 limit 1",
}
for _name, _text in _SIMPLE.items():
    sql(_name, lambda d, text=_text: text)
