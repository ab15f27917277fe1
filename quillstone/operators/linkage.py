"""Duplicates, record linkage, votes and eras."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import names
from quillstone.plans.checkpoint import checkpoint


def resolve_duplicates(rows: DataFrame, *, group: list[Column], best: list[Column], id_col: str = "id") -> DataFrame:
    """The best row of each group, with ``duplicate_ids`` of those it stands for ("; " between).

    best: expressions of which the largest wins, one after another; then the least id. One aggregate: the best row
    and the ids of all, pre-aggregated before the shuffle.
    """
    keys = [g.alias(f"__g{i}") for i, g in enumerate(group)]
    order = F.struct(*[b.alias(f"b{i}") for i, b in enumerate(best)], (-F.col(id_col)).alias("id"))
    rest = [c for c in rows.columns if c != id_col]
    packed = rows.select(*keys, F.col(id_col).alias("__id"), order.alias("__order"), F.struct(*rest).alias("__row"))
    found = packed.groupBy(*[f"__g{i}" for i in range(len(group))]).agg(F.max_by(F.struct("__id", "__row"), "__order").alias("__top"), F.sort_array(F.collect_list("__id")).alias("__ids"))
    others = F.filter("__ids", lambda x: x != F.col("__top.__id"))
    return found.select(F.col("__top.__id").alias(id_col), "__top.__row.*", F.array_join(F.transform(others, lambda x: x.cast("string")), "; ").alias("duplicate_ids"))


def union_first(arms: list[DataFrame], id_col: str = "id") -> DataFrame:
    """Rows of several searches once each, from the first that has them, with all ``arms`` that do."""
    tagged = None
    for i, arm in enumerate(arms):
        one = arm.withColumn("arm", F.lit(i))
        tagged = one if tagged is None else tagged.unionByName(one)
    w = Window.partitionBy(id_col)
    return tagged.withColumn("arms", F.sort_array(F.collect_set("arm").over(w))).withColumn("__n", F.row_number().over(w.orderBy("arm"))).where("__n = 1").drop("__n")


def best_candidate(pairs: DataFrame, *, sim: str, author: str, eligible: Column, gap: float = 0.02, confirm: float = 0.90, key: str = "id", candidate: str = "candidate") -> DataFrame:
    """The verdict on each record from its scored candidates.

    Candidates are filtered by the gate first and ranked after. pairs also hold ``digits`` (numbers
    differ) and ``both_named`` (both sides have author words). Records without a candidate have a row
    with a null candidate.
    """
    real = F.col(candidate).isNotNull()
    ok = real & F.coalesce(eligible, F.lit(False))
    w = Window.partitionBy(key).orderBy(ok.desc(), F.desc_nulls_last(sim), F.desc_nulls_last(author), F.asc_nulls_last(candidate))
    nxt = lambda c: F.lead(c).over(w)
    marked = pairs.withColumn("__ok", ok)
    top = marked.select("*", F.row_number().over(w).alias("__n"), nxt(sim).alias("__sim2"), nxt(author).alias("__author2"), nxt("__ok").alias("__ok2")).where("__n = 1")
    close = F.coalesce(F.col("__ok2"), F.lit(False)) & (F.col(sim) - F.col("__sim2") < gap) & (F.col(author) <= F.col("__author2"))
    verdict = (
        F.when(~real, "no_candidate")
        .when(~F.col("__ok") & (F.col(sim) < confirm), "weak_title")
        .when(~F.col("__ok") & F.col("digits"), "digits_conflict")
        .when(~F.col("__ok"), "rejected_wrong_journal")
        .when(close, "ambiguous_candidates")
        .when(F.col(sim) < confirm, "weak_title")
        .when(F.col("both_named") & (F.col(author) == 0), "authors_disagree")
        .otherwise("recovered")
    )
    return top.withColumn("verdict", verdict).withColumn("tier", F.when(F.col("verdict") == "recovered", "B").otherwise("C")).drop("__n", "__sim2", "__author2", "__ok2", "__ok")


def registry_search(records: DataFrame, registry: DataFrame, *, same: list[str], band: str, width: int, text: str, sim: Callable[[Column, Column], Column], k: int = 5, size: int = 1024) -> DataFrame:
    """(id, candidate, sim): the k registry entries most like each record in ``text``, ties to the smaller candidate.

    Candidates have other ids, are equal in ``same``, and differ by ``width`` at most in ``band``, a whole number. records have
    id, registry has candidate, both have those columns. sim of two texts is 1 for equal ones and less for others.

    Rows that agree in all of these columns have the same candidates but for themselves. So texts are compared once for two
    classes of rows, and of a class only its first ids stand for it: as many as can be among the best of any row. Where a
    text is in the band often enough, no other text is compared with it. Other texts meet in blocks that are dealt out one
    by one, and of a block a text keeps its best at once, so that comparisons are never rows.
    """
    near = [*same, band]
    whole = lambda rows, key: rows.select(key, *same, F.col(band).cast("long").alias(band), text).dropna(subset=[key, *near])
    records, registry = whole(records, "id"), whole(registry, "candidate")
    # A record leaves out its own id, which can be on so many rows.
    keep = k + (registry.groupBy("candidate").count().agg(F.max("count")).first()[0] or 0)
    first = lambda x: F.slice(F.sort_array(x), 1, keep)
    # What sorts as SQL does, nulls last; entries are (order, candidate).
    order = lambda a, b: F.coalesce(-sim(a, b), F.lit(float("inf")))
    entries = lambda o, ids: F.transform(ids, lambda c: F.struct(o.alias("order"), c.alias("candidate")))
    named = lambda value, f: F.transform(F.array(value), f)[0]  # noqa: E731 (worked out once)

    w = Window.partitionBy(*near, text).orderBy("candidate")
    classes = registry.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= keep).groupBy(*near, text).agg(F.collect_list("candidate").alias("__ids"))
    spread = classes.withColumn(band, F.explode(F.sequence(F.col(band) - width, F.col(band) + width))).withColumn("__asked", F.lit(False))
    asked = records.select(*near, text).distinct().withColumns({"__ids": F.lit(None), "__asked": F.lit(True)})
    texts = checkpoint(spread.unionByName(asked).groupBy(*near, text).agg(first(F.flatten(F.collect_list("__ids"))).alias("__ids"), F.max("__asked").alias("__asked")))
    # Of texts this long, equal and almost equal ones could have the same rounded measure.
    enough = (F.size("__ids") >= keep) & F.coalesce(F.char_length(text) < 1_000_000, F.lit(False))
    alone = texts.where(F.col("__asked") & enough).select(*near, text, named(order(F.col(text), F.col(text)), lambda o: entries(o, F.col("__ids"))).alias("__best"))

    left = _text_blocks(texts.where(F.col("__asked") & ~enough).select(*near, F.struct(F.col(text).alias("text")).alias("__x")), near, max(1, size // 4)).withColumnRenamed("__all", "__left")
    right = _text_blocks(texts.where(F.size("__ids") > 0).select(*near, F.struct(F.col(text).alias("text"), "__ids").alias("__x")), near, size).withColumnRenamed("__all", "__right")
    met = _dealt(left.join(right, near)).select(*near, "__right", F.explode("__left.text").alias(text))
    tagged = lambda orders: F.zip_with(orders, "__right", lambda o, x: F.struct(o.alias("order"), x["__ids"].alias("ids")))
    last = lambda orders: F.sort_array(orders)[F.least(F.lit(keep), F.size(orders)) - 1]
    cut = lambda orders: named(last(orders), lambda most: F.filter(tagged(orders), lambda x: x["order"] <= most))
    nearest = named(F.transform("__right", lambda x: order(F.col(text), x["text"])), cut)
    scored = met.select(*near, text, first(F.flatten(F.transform(nearest, lambda x: entries(x["order"], x["ids"])))).alias("__best"))
    best = scored.groupBy(*near, text).agg(first(F.flatten(F.collect_list("__best"))).alias("__best"))

    lists = alone.unionByName(best).select(*[F.col(c).alias(f"__{c}") for c in [*near, text]], "__best")
    on = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"__{c}") for c in near]) & F.col(text).eqNullSafe(F.col(f"__{text}"))
    found = records.join(lists, on).select("id", F.explode(F.slice(F.filter("__best", lambda x: x["candidate"] != F.col("id")), 1, k)).alias("x"))
    ranked = found.withColumn("__n", F.row_number().over(Window.partitionBy("id").orderBy("x"))).where(F.col("__n") <= k)
    return ranked.select("id", "x.candidate", F.when(F.col("x.order") < float("inf"), -F.col("x.order")).alias("sim"))


def _text_blocks(rows: DataFrame, by: list[str], size: int, chars: int = 1 << 20) -> DataFrame:
    """(by, __all): the rows' ``__x`` in order of its text, cut into blocks of so many, and of about so many characters."""
    w = Window.partitionBy(*by).orderBy("__x.text")
    nth, far = F.row_number().over(w) - 1, F.sum(F.coalesce(F.char_length("__x.text"), F.lit(0))).over(w)
    return rows.select("*", F.floor(nth / size).alias("__nth"), F.floor(far / chars).alias("__far")).groupBy(*by, "__nth", "__far").agg(F.collect_list("__x").alias("__all")).drop("__nth", "__far")


def rule_arm(records: DataFrame, registry: DataFrame, *, candidate: Column, sim: Column, confirm: float = 0.90) -> DataFrame:
    """Records whose identifier follows from a rule: no_rule_match, candidate_not_in_crossref, title_mismatch or recovered."""
    # Records without a candidate meet nothing; they are dealt by their own columns, so that they don't share a task.
    made = records.withColumn("candidate", candidate)
    key = F.coalesce(F.lower("candidate"), F.xxhash64(*records.columns).cast("string"))
    entries = registry.select(F.lower("doi").alias("__doi"), F.col("title").alias("registry_title"))
    found = made.withColumn("__key", key).join(entries, (F.col("__key") == F.col("__doi")) & F.col("candidate").isNotNull(), "left").drop("__key")
    verdict = F.when(F.col("candidate").isNull(), "no_rule_match").when(F.col("__doi").isNull(), "candidate_not_in_crossref").when(sim >= confirm, "recovered").otherwise("title_mismatch")
    return found.withColumn("verdict", verdict).withColumn("tier", F.when(F.col("verdict") == "recovered", "A").otherwise("C")).drop("__doi")


def majority(votes: DataFrame, *, key: str, vote: str, least: int = 10, share: float = 0.80) -> DataFrame:
    """(key, vote, n, total, agreement, verdict): the most frequent vote, proposed when votes are many and agree."""
    counted = votes.groupBy(key, vote).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key)
    top = counted.withColumn("total", F.sum("n").over(w)).withColumn("__n", F.row_number().over(w.orderBy(F.desc("n"), F.asc(vote)))).where("__n = 1").drop("__n")
    agreement = F.round(F.col("n") / F.col("total"), 4)
    verdict = F.when(F.col("total") < least, "too_few_votes").when(F.col("n") / F.col("total") < share, "no_agreement").otherwise("proposed")
    return top.select(key, vote, "n", "total", agreement.alias("agreement"), verdict.alias("verdict"))


def hash_sample(rows: DataFrame, *, by: list[str], id_col: str, n: int, factor: int = 2654435761, modulus: int = 1000003) -> DataFrame:
    """n rows of each group in a fixed pseudo-random order of ids."""
    order = F.pmod(F.col(id_col).cast("long") * F.lit(factor), F.lit(modulus))
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(order, id_col))).where(F.col("rn") <= n)


def md5_sample(rows: DataFrame, *, id_col: str, seed: str, n: int) -> DataFrame:
    return rows.orderBy(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed))), id_col).limit(n)


def stratified(strata: list[DataFrame], id_col: str = "id") -> DataFrame:
    """The union of strata; a row counts for the first one that has it."""
    return union_first(strata, id_col).drop("arms").withColumnRenamed("arm", "stratum")


def eras(samples: DataFrame, *, least: int = 3) -> DataFrame:
    """How each group of numbers of a journal relates to its largest: same, rename or contamination.

    samples: (journal, issns, year). Groups are by the sorted set of numbers, small ones are left out.
    """
    grouped = samples.groupBy("journal", F.sort_array("issns").alias("issns")).agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("first"), F.max("year").alias("last")).where(F.col("n") >= least)
    w = Window.partitionBy("journal").orderBy(F.desc("n"), F.array_join("issns", "|"))
    placed = grouped.withColumn("__n", F.row_number().over(w))
    main = placed.where("__n = 1").select("journal", *[F.col(c).alias(f"primary_{c}") for c in ("issns", "n", "first", "last")])
    both = placed.where("__n > 1").drop("__n").join(main, "journal")
    later = F.col("first") >= F.col("primary_first")
    early = lambda c: F.when(later, F.col(f"primary_{c}")).otherwise(F.col(c))
    late = lambda c: F.when(later, F.col(c)).otherwise(F.col(f"primary_{c}"))
    kind = F.when(F.arrays_overlap("issns", "primary_issns"), "same_journal_variant_deposit").when(late("last") <= early("last"), "contamination").when(late("first") >= early("last") - 2, "rename").otherwise("contamination")
    return both.withColumn("kind", kind)


def grouped_credits(links: DataFrame) -> DataFrame:
    """(paper_id, grp, keep_id, author_id): credits of a paper that may be one person.

    Grouping depends on order and is not transitive, so each paper is worked on by itself, sorted by author (nulls last)
    and name. Papers come sorted, many to a batch, and go on in the next; Python holds the byline of one paper at a time.
    """
    import pyarrow as pa

    out = pa.schema([(c, pa.int64()) for c in ("paper_id", "grp", "keep_id", "author_id")])

    def run(batches):
        grouping = lru_cache(1 << 16)(names.group_names)
        paper, authors, given, rows = None, [], [], ([], [], [], [])

        def close() -> None:
            for at, members, keep in (grouping if len(given) <= 32 else names.group_names)(tuple(given)):
                rows[0].extend([paper] * len(members))
                rows[1].extend([at] * len(members))
                rows[2].extend([authors[keep]] * len(members))
                rows[3].extend([authors[i] for i in members])
            authors.clear()
            given.clear()

        def flush():
            batch = pa.record_batch([pa.array(c, pa.int64()) for c in rows], schema=out)
            for c in rows:
                c.clear()
            return batch

        for batch in batches:
            for p, a, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if p != paper:
                    close()
                    paper = p
                    if len(rows[0]) >= 1 << 16:
                        yield flush()
                authors.append(a)
                given.append(n)
        close()
        yield flush()

    whole = links.select(F.col("paper_id").cast("long"), F.col("author_id").cast("long"), "name")
    dealt = whole.repartition("paper_id").sortWithinPartitions("paper_id", F.asc_nulls_last("author_id"), "name")
    return dealt.mapInArrow(run, "paper_id long, grp long, keep_id long, author_id long")


def _blocks(rows: DataFrame, by: str, value: str, size: int) -> DataFrame:
    """(by, nth, all): the values of a group in order, cut into blocks."""
    nth = F.row_number().over(Window.partitionBy(by).orderBy(value)) - 1
    return rows.select(by, value).withColumn("nth", F.floor(nth / size)).groupBy(by, "nth").agg(F.sort_array(F.collect_list(value)).alias("all"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows one by one to more tasks than there are cores, which AQE doesn't join again."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


def _expanded(met: DataFrame) -> DataFrame:
    """(x, y): each value of ``xs`` with each of ``ys``, where they are one block (``same``) with the later ones only.

    Pairs of blocks are dealt out one by one, so that a task's work doesn't grow with a group.
    """
    one = _dealt(met).select("ys", "same", F.posexplode("xs").alias("i", "x"))
    return one.select("x", "i", "same", F.posexplode("ys").alias("j", "y")).where(~F.col("same") | (F.col("i") < F.col("j"))).select("x", "y")


def name_pairs(people: DataFrame, *, size: int = 1024) -> DataFrame:
    """(a, b): ids a < b of people (id, p: a parsed name or null) that may be one person.

    Two forms of a name are compared once, however many people have them. The result is as long as the pairs by definition.
    """
    people = people.dropna(subset=["id", "p"])
    forms = _blocks(people.select(F.col("p.surname").alias("surname"), "p").distinct(), "surname", "p", max(1, size // 8))
    left, right = forms.select("surname", F.col("nth").alias("m"), F.col("all").alias("xs")), forms.select("surname", F.col("nth").alias("n"), F.col("all").alias("ys"))
    other = _expanded(left.join(right, "surname").where("m <= n").select("xs", "ys", (F.col("m") == F.col("n")).alias("same")))
    links = other.where(names.compatible_columns(F.col("x"), F.col("y"))).unionAll(people.select(F.col("p").alias("x"), F.col("p").alias("y")).distinct())
    ids = _blocks(people, "p", "id", size)
    xs, ys = ids.select(F.col("p").alias("x"), F.col("nth").alias("m"), F.col("all").alias("xs")), ids.select(F.col("p").alias("y"), F.col("nth").alias("n"), F.col("all").alias("ys"))
    met = links.join(xs, "x").join(ys, "y").withColumn("own", F.col("x") == F.col("y")).where("not own or m <= n")
    pairs = _expanded(met.select("xs", "ys", (F.col("own") & (F.col("m") == F.col("n"))).alias("same"))).where("x <> y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def merge_gates(groups: DataFrame) -> DataFrame:
    """Groups of credits with ``refused``: the first reason against a merge, or null.

    groups: found, sim, parsed, size, registry_same_surname, surname_is_given, bare_initials, repeat.
    """
    reason = (
        F.when(~F.col("found") | (F.col("sim") < 0.90), "registry_unconfirmed")
        .when(F.col("parsed") < 2, "fewer_than_two_parsed")
        .when(F.col("size") < 2, "no_group")
        .when(F.col("registry_same_surname") >= 2, "registry_lists_surname_twice")
        .when((F.col("registry_same_surname") == 0) & F.col("surname_is_given"), "surname_is_a_given_name")
        .when(F.col("bare_initials") >= 2, "bare_surname_with_two_initials")
        .when(F.col("repeat"), "repeated_link")
    )
    return groups.withColumn("refused", reason)


def resolve_surnames(mentions: DataFrame) -> DataFrame:
    """(mention, person): surname and initial name a person; where first names contest a key, the full first name does.

    Mentions of a contested key by initial alone can't be assigned and have a null person.
    """
    keyed = mentions.select("mention", names.surname_key_columns(F.col("mention")).alias("k")).select("mention", "k.key", "k.first")
    full = F.char_length("first") > 2
    contested = keyed.where(full).groupBy("key").agg(F.count_distinct("first").alias("forms"))
    joined = keyed.join(contested, "key", "left")
    person = F.when(F.coalesce("forms", F.lit(0)) <= 1, F.col("key")).when(full, F.concat_ws("|", "key", "first"))
    return joined.select("mention", person.alias("person"))


def apply_mapping(rows: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """The column by its canonical name, where the mapping (raw, canonical) has one."""
    m = mapping.select(F.col("raw").alias("__raw"), F.col("canonical").alias("__canonical"))
    return rows.join(m, F.col(column) == F.col("__raw"), "left").withColumn(column, F.coalesce("__canonical", column)).drop("__raw", "__canonical")
