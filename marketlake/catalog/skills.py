"""Skills in ``documents`` and their graph; the terms and synonyms are taken from ``benchmark``."""

from pyspark.sql import functions as F

from marketlake.catalog.base import query, table
from marketlake.operators.graph import cooccurrence, propagate_labels
from marketlake.operators.terms import SEPARATORS, extract_terms, merged_terms, trie, words
from marketlake.session import materialize

#: Terms are the 2, 3 and 4 words from these places of an item on; the longer are synonyms of the shorter.
PLACES, LONGEST = (0, 3, 8), 4
LEAST_SHARE, LEAST_WEIGHT = 0.2, 3


def dictionary(spark, sf):
    items = table(spark, sf, "benchmark").select(words(F.col("text")).alias("w"))
    at = items.select("w", F.explode(F.array(*[F.lit(p) for p in PLACES])).alias("p")).filter(F.size("w") >= F.col("p") + LONGEST)
    some = at.select(*[F.array_join(F.slice("w", F.col("p") + 1, n), " ").alias(f"t{n}") for n in (2, 3, 4)])
    terms = some.select(F.explode(F.array("t2", "t3", "t4")).alias("term")).distinct()
    synonyms = some.select(F.explode(F.array(
        F.struct(F.col("t2").alias("a"), F.col("t3").alias("b")),
        F.struct(F.col("t3").alias("a"), F.col("t4").alias("b")))).alias("s")).select("s.a", "s.b")
    return materialize(trie(merged_terms(terms, synonyms)), "trie")


def skills(spark, sf):
    return extract_terms(table(spark, sf, "documents"), dictionary(spark, sf), LONGEST, "doc_id", "text")


_SEPARATORS = "||".join(f"chr({ord(c)})" for c in SEPARATORS)
_WORDS = """list_filter(string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || {s},
  'abcdefghijklmnopqrstuvwxyz' || repeat(' ', {n})), ' '), lambda w: w <> '')""".format(s=_SEPARATORS, n=len(SEPARATORS))
_SKILLS = f"""with recursive items as (select {_WORDS} as w from benchmark),
cut as (select array_to_string(w[p + 1 : p + 2], ' ') as t2, array_to_string(w[p + 1 : p + 3], ' ') as t3,
  array_to_string(w[p + 1 : p + 4], ' ') as t4 from items, (select unnest({list(PLACES)}) as p) where len(w) >= p + {LONGEST}),
terms as (select distinct unnest([t2, t3, t4]) as term from cut),
pair as (select t2 as a, t3 as b from cut union select t3, t2 from cut union select t3, t4 from cut union select t4, t3 from cut),
reach(term, other) as (select term, term from terms union select r.term, p.b from reach r join pair p on p.a = r.other),
names as (select term, min(other) as skill from reach group by term),
d as (select doc_id, {_WORDS} as w from documents),
places as (select doc_id, start, max(size) as size from (
  select doc_id, start, n as size, array_to_string(w[start + 1 : start + n], ' ') as term
  from (select doc_id, w, unnest(range(len(w))) as start from d), (select unnest([2, 3, 4]) as n) where start + n <= len(w))
 where term in (select term from terms) group by doc_id, start),
kept(doc_id, start, size) as (
 select doc_id, min(start), arg_min(size, start) from places group by doc_id
 union all
 select k.doc_id, min(p.start), arg_min(p.size, p.start) from kept k join places p
 on p.doc_id = k.doc_id and p.start >= k.start + k.size group by k.doc_id),
skills as (select k.doc_id, k.start::int as start, k.size::int as size, names.skill
 from kept k join d using (doc_id) join names on names.term = array_to_string(d.w[k.start + 1 : k.start + k.size], ' '))"""


@query("g2_skills", _SKILLS + " select * from skills")
def g2(spark, sf):
    return skills(spark, sf)


def _edges(spark, sf):
    return cooccurrence(skills(spark, sf), "doc_id", "skill", LEAST_SHARE, LEAST_WEIGHT)


@query("g3_skill_pairs", _SKILLS + f""", held as (select distinct doc_id, skill from skills),
n as (select skill, count(*) as n from held group by skill),
pairs as (select x.skill as a, y.skill as b, count(*) as weight from held x join held y using (doc_id)
 where x.skill < y.skill group by all)
select a, b, weight, round(weight / (na.n + nb.n - weight), 9) as share
from pairs join n na on na.skill = a join n nb on nb.skill = b
where weight >= {LEAST_WEIGHT} and weight / (na.n + nb.n - weight) >= {LEAST_SHARE}""")
def g3_pairs(spark, sf):
    return _edges(spark, sf).withColumn("share", F.round("share", 9))


@query("g3_skill_clusters")
def g3_clusters(spark, sf):
    return propagate_labels(_edges(spark, sf)).withColumnsRenamed({"node": "skill", "label": "cluster"})
