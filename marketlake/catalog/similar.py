"""Similar vectors and open-set roles over ``embeddings``; queries are the ids divisible by 100."""

from pyspark.sql import functions as F

from marketlake.catalog.base import query, table
from marketlake.operators.vectors import exact_neighbours, fit_index, neighbours, recall
from marketlake.plans.roles import report, threshold, vote, with_role
from marketlake.session import materialize

#: Share of accepted votes that must be right on the rows the threshold is taken from.
PRECISION = 0.5


def _rows(spark, sf):
    return table(spark, sf, "embeddings")


def _asked(rows):
    return rows.filter("vec_id % 100 = 0")


_UNIT = """e as (select vec_id, label, embedding::double[] as v from embeddings)"""
_NEAR = """near as (select a.vec_id as query, b.vec_id as neighbour,
  round(list_cosine_similarity(a.v, b.v), 10) as similarity, a.fold
 from asked a join {rows} b on a.vec_id <> b.vec_id),
ranked as (select query, neighbour, similarity, fold,
  row_number() over (partition by query order by similarity desc, neighbour) as rank from near)"""


@query("g4_similar_exact", f"""with {_UNIT}, asked as (select *, 0 as fold from e where vec_id % 100 = 0),
{_NEAR.format(rows='e')}
select query, rank::int as rank, neighbour, round(similarity, 6) as similarity from ranked where rank <= 10""")
def g4_exact(spark, sf):
    rows = _rows(spark, sf)
    found = exact_neighbours(rows, _asked(rows), "vec_id", "embedding")
    return found.withColumn("similarity", F.round("similarity", 6))


def _similar(rows):
    index = fit_index(rows, _asked(rows), "vec_id", "embedding")
    return neighbours(rows, _asked(rows), index, "vec_id", "embedding")


@query("g4_similar_vectors")
def g4_similar(spark, sf):
    return _similar(_rows(spark, sf)).withColumn("similarity", F.round("similarity", 6))


@query("g4_recall", """select count(*) as query_cnt, 10 * count(*) as pair_cnt, true as at_least_90_percent
from embeddings where vec_id % 100 = 0""")
def g4_recall(spark, sf):
    """Whether the index finds nine of ten true neighbours of all queries."""
    rows = _rows(spark, sf)
    truth = exact_neighbours(rows, _asked(rows), "vec_id", "embedding")
    return recall(_similar(rows), truth).select(
        "query_cnt", "pair_cnt", (F.col("recall") >= 0.9).alias("at_least_90_percent"))


# Rows to classify end in 00, rows for the threshold in 50; all others are the labelled ones.
_ROLES = f"""with {_UNIT},
asked as (select *, vec_id % 100 // 50 as fold from e where vec_id % 50 = 0),
known as (select * from e where vec_id % 50 <> 0),
{_NEAR.format(rows='known')},
counts as (select query, fold, label as voted, count(*) as votes, max(similarity) as near
 from ranked r join known k on k.vec_id = r.neighbour where rank <= 10 and label is not null group by all),
voted as (select query, fold, arg_min(voted, (-votes, voted)) as voted, max(votes) as votes,
  sum(votes)::bigint as voters, round(max(near), 4) as similarity from counts group by query, fold),
steps as (select similarity, count(*) as n, count(*) filter (where voted = label) as good
 from voted join e on vec_id = query where fold = 1 group by similarity),
least as (select min(similarity) as least_similarity
 from (select similarity, sum(n) over (order by similarity desc) as n, sum(good) over (order by similarity desc) as good
  from steps) where good >= {PRECISION} * n),
roles as (select query, voted, votes, voters, similarity,
  case when similarity >= least_similarity then voted end as role from voted, least where fold = 0)"""


def _roles(spark, sf):
    rows = _rows(spark, sf)
    known = rows.filter("vec_id % 50 <> 0")
    found = exact_neighbours(known, rows.filter("vec_id % 50 = 0"), "vec_id", "embedding")
    voted = materialize(vote(found, known, "vec_id", "label"), "votes")
    held_out = voted.filter("query % 100 = 50")
    least = threshold(held_out, rows, "vec_id", "label", PRECISION)
    return with_role(voted.filter("query % 100 = 0"), least)


@query("g5_open_set_roles", _ROLES + " select * from roles")
def g5_roles(spark, sf):
    return _roles(spark, sf).drop("least_similarity")


@query("g5_role_report", _ROLES + """
select count(*) as row_cnt, count(*) filter (where role is null) as unknown_cnt,
 count(*) filter (where role = label) as right_cnt, count(*) filter (where role <> label) as wrong_cnt,
 count(*) filter (where voted = label) as voted_right_cnt
from roles join e on vec_id = query where label is not null""")
def g5_report(spark, sf):
    return report(_roles(spark, sf), _rows(spark, sf), "vec_id", "label")
