"""Frequent-pattern plans: part types bought together, event types in daily order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import r6
from bramble.operators import patterns as pt
from bramble.plans.registry import Tables, plan
from bramble.plans.registry import r6 as sql6

_SUPPORT, _CONFIDENCE = 0.1, 0.46

# every subset of every basket, grown one item at a time in alphabetical order
_SETS = f"""WITH RECURSIVE b AS (SELECT DISTINCT l_orderkey AS o, p_type AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
    s AS (SELECT o, i AS last, i AS items, 1 AS size FROM b
          UNION ALL SELECT s.o, b.i, s.items || '_' || b.i, s.size + 1 FROM s JOIN b ON s.o = b.o AND b.i > s.last),
    total AS (SELECT count(DISTINCT o) AS n FROM b),
    f AS (SELECT items, any_value(size) AS size, count(*) AS freq FROM s GROUP BY items
          HAVING count(*) >= ceil({_SUPPORT} * (SELECT n FROM total))),
    r AS (SELECT list_filter(string_split(whole.items, '_'), lambda x: x <> c.items) AS a, c.items AS consequent,
                 whole.freq FROM f whole JOIN f c ON c.size = 1 AND whole.size > 1
                 AND list_contains(string_split(whole.items, '_'), c.items)),
    rules AS (SELECT a, array_to_string(a, '_') AS antecedent, consequent, r.freq / f.freq AS confidence,
                     r.freq / f.freq / (c.freq / total.n) AS lift, r.freq / total.n AS support
              FROM r JOIN f ON f.items = array_to_string(a, '_') JOIN f c ON c.items = consequent, total
              WHERE r.freq / f.freq >= {_CONFIDENCE})
"""


def _bought(t: Tables) -> DataFrame:
    joined = t.lineitem.select("l_orderkey", "l_partkey") \
        .join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return pt.baskets(joined, "l_orderkey", "p_type")


def _model(t: Tables):
    return pt.mine(_bought(t), min_support=_SUPPORT, min_confidence=_CONFIDENCE)


@plan("L5")
def seq_patterns_long(t: Tables) -> DataFrame:
    """Frequent sequences of the full length of five."""
    found = pt.frequent_sequences(pt.sequences(t.events, "user_id", "ts", "event_type"), min_support=0.6, max_length=5)
    steps = F.transform("sequence", lambda s: F.array_join(F.array_sort(s), ","))
    return found.select(F.array_join(steps, ";").alias("pattern"), "freq")


@plan("L1", oracle=_SETS + "SELECT items, freq FROM f")
def itemsets(t: Tables) -> DataFrame:
    return _model(t).freqItemsets.select(pt.item_key("items").alias("items"), "freq")


@plan("L2", oracle=_SETS + f"""
    SELECT antecedent, consequent, {sql6('confidence')} AS confidence, {sql6('lift')} AS lift,
           {sql6('support')} AS support FROM rules""")
def rules(t: Tables) -> DataFrame:
    return _model(t).associationRules.select(
        pt.item_key("antecedent").alias("antecedent"), F.col("consequent")[0].alias("consequent"),
        *[r6(c).alias(c) for c in ("confidence", "lift", "support")])


@plan("L3", oracle=_SETS + """
    , k AS (SELECT o, list(i) AS have FROM b GROUP BY o),
    m AS (SELECT DISTINCT o, consequent FROM k JOIN rules ON list_has_all(have, a) AND NOT list_contains(have, consequent))
    SELECT o AS l_orderkey, string_agg(consequent, '_' ORDER BY consequent) AS suggested FROM m GROUP BY o""")
def rule_apply(t: Tables) -> DataFrame:
    rows = _bought(t)
    model = pt.mine(rows, min_support=_SUPPORT, min_confidence=_CONFIDENCE)
    return pt.apply_rules(rows, "l_orderkey", model.associationRules) \
        .select("l_orderkey", pt.item_key("prediction").alias("suggested"))


@plan("L4 D5", oracle=_SETS + """
    , q AS (SELECT antecedent AS item, consequent, row_number() OVER (PARTITION BY antecedent
                ORDER BY confidence DESC, consequent) AS o FROM rules WHERE len(a) = 1)
    SELECT item, string_agg(consequent, '_' ORDER BY o) AS also FROM q WHERE o <= 5 GROUP BY item""")
def rule_rollup(t: Tables) -> DataFrame:
    return pt.rule_rollup(_model(t).associationRules).select("item", F.array_join("also", "_").alias("also"))


@plan("L5", oracle="""
    WITH e AS (SELECT DISTINCT user_id AS u, ts::DATE AS d, event_type AS k FROM events),
    n AS (SELECT count(DISTINCT u) AS n FROM e),
    p AS (SELECT u, k AS pattern FROM e
          UNION SELECT a.u, a.k || ',' || b.k FROM e a JOIN e b ON a.u = b.u AND a.d = b.d AND a.k < b.k
          UNION SELECT a.u, a.k || ';' || b.k FROM e a JOIN e b ON a.u = b.u AND a.d < b.d)
    SELECT pattern, count(*) AS freq FROM p GROUP BY pattern HAVING count(*) >= ceil(0.5 * (SELECT n FROM n))""")
def seq_patterns(t: Tables) -> DataFrame:
    found = pt.frequent_sequences(pt.sequences(t.events, "user_id", "ts", "event_type"), max_length=2)
    steps = F.transform("sequence", lambda s: F.array_join(F.array_sort(s), ","))
    return found.select(F.array_join(steps, ";").alias("pattern"), "freq")
