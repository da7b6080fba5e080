"""DuckDB text of the tree models: trees are grown by a recursion over levels.

The recursion's rows are the training rows of every tree with the path (0 left, 1 right) of the node
they are in; a level finds the best split of each open node and moves its rows on. Node tables,
predictions and importances are read from the rows of all levels.
"""

from riskloom.models import boosting, forest
from riskloom.models.splits import GAIN_DIGITS, MIN_GAIN, TARGET_CANDIDATES
from riskloom.models.trees import PURE
from riskloom.schemas import LABEL


def _impurity(pos, wgt):
    return f"CASE WHEN {wgt} > 0 THEN 1 - (pow({pos} / {wgt}, 2) + pow(1 - {pos} / {wgt}, 2)) ELSE 0e0 END"


def long_rows(names, source="dataset"):
    """(id, feature, v) of the rows in ``source``."""
    return " UNION ALL ".join(
        f"SELECT customer_id AS id, {j} AS feature, {name} AS v FROM {source}" for j, name in enumerate(names))


def _best(rows, keys, min_split, subsets):
    """The split of each node that has one; ``rows`` has keys, id, n, wn (weight), wp (positive weight)."""
    node = ", ".join(keys)
    on = "USING (tree)" if "tree" in keys else "ON true"
    return f"""
    SELECT {node}, feature, v AS threshold FROM (
      SELECT *, row_number() OVER (PARTITION BY {node} ORDER BY gain DESC, position, v) AS choice FROM (
        SELECT *, round({_impurity('tp', 'tw')} - (ln * ({_impurity('lp', 'lw')})
          + (tn - ln) * ({_impurity('(tp - lp)', '(tw - lw)')})) / tn, {GAIN_DIGITS}) AS gain FROM (
          SELECT *, row_number() OVER upto - 1 AS k, count(*) OVER whole AS l,
            sum(n) OVER upto AS ln, sum(wn) OVER upto AS lw, sum(wp) OVER upto AS lp,
            sum(n) OVER whole AS tn, sum(wn) OVER whole AS tw, sum(wp) OVER whole AS tp
          FROM (
            SELECT {", ".join("r." + k for k in keys)}, s.position, s.feature, x.v, sum(n) AS n, sum(wn) AS wn, sum(wp) AS wp
            FROM {rows} r JOIN {subsets} s {on} JOIN train_values x ON x.id = r.id AND x.feature = s.feature
            GROUP BY ALL) stats
          WINDOW upto AS (PARTITION BY {node}, position ORDER BY v ROWS UNBOUNDED PRECEDING),
                 whole AS (PARTITION BY {node}, position)) running
        WHERE k % greatest(l // {TARGET_CANDIDATES}, 1) = 0 AND ln < tn AND tn >= {min_split}
          AND tp / tw > {PURE!r} AND tp / tw < {1 - PURE!r}) gains
      WHERE gain > {MIN_GAIN!r}) ranked
    WHERE choice = 1"""


def _grown(depth, min_split):
    """Trees over ``tree_rows`` (tree, id, n, wn, wp) with the features of ``tree_features``."""
    here = "(SELECT g.*, n, wn, wp FROM grown g JOIN tree_rows USING (tree, id))"
    return f"""
  grown AS (
    SELECT 0 AS level, tree, id, '' AS path, CAST(NULL AS INTEGER) AS feature, CAST(NULL AS DOUBLE) AS threshold
    FROM tree_rows
    UNION ALL
    SELECT g.level + 1, g.tree, g.id, g.path || CASE WHEN x.v <= b.threshold THEN '0' ELSE '1' END, b.feature, b.threshold
    FROM grown g JOIN ({_best(here, ["tree", "path"], min_split, "tree_features")}) b
      ON b.tree = g.tree AND b.path = g.path JOIN train_values x ON x.id = g.id AND x.feature = b.feature
    WHERE g.level < {depth})"""


#: Nodes in the order in which levels create them: one row each, with the split below.
_NODES = """
  tree_nodes AS (
    SELECT {order} level, tree, path, CAST(sum(n) AS BIGINT) AS samples,
      CASE WHEN sum(wn) > 0 THEN sum(wp) / sum(wn) ELSE 0e0 END AS probability,
      any_value(feature) AS feature_above, any_value(threshold) AS threshold_above,
      row_number() OVER (ORDER BY {order} level, tree, path) - 1 AS node
    FROM ({rows}) r GROUP BY {order} level, tree, path)"""


def _node_table(names):
    case = " ".join(f"WHEN {j} THEN '{n}'" for j, n in enumerate(names))
    return f"""
  SELECT CAST(p.tree AS INTEGER) AS tree, CAST(p.node AS INTEGER) AS node,
    CASE l.feature_above {case} END AS feature, round(l.threshold_above, 6) AS threshold,
    CAST(l.node AS INTEGER) AS "left", CAST(r.node AS INTEGER) AS "right",
    round(p.probability, 6) AS probability, p.samples
  FROM tree_nodes p LEFT JOIN tree_nodes l ON l.tree = p.tree AND l.path = p.path || '0'
    LEFT JOIN tree_nodes r ON r.tree = p.tree AND r.path = p.path || '1'"""


def _walked(source):
    """(id, tree, probability) of the leaf that each row of ``source`` reaches."""
    return f"""
  splits AS (SELECT p.tree, p.path, p.probability, l.feature_above AS feature, l.threshold_above AS threshold
    FROM tree_nodes p LEFT JOIN tree_nodes l ON l.tree = p.tree AND l.path = p.path || '0'),
  asked AS ({source}),
  walk AS (
    SELECT customer_id AS id, tree, path, probability, feature, threshold FROM asked, splits WHERE path = ''
    UNION ALL
    SELECT w.id, w.tree, s.path, s.probability, s.feature, s.threshold
    FROM walk w JOIN asked_values x ON x.id = w.id AND x.feature = w.feature
      JOIN splits s ON s.tree = w.tree AND s.path = w.path || CASE WHEN x.v <= w.threshold THEN '0' ELSE '1' END),
  leaves AS (SELECT id, tree, probability FROM walk WHERE feature IS NULL)"""


def _all_features(trees, width):
    return f"SELECT tree, feature AS position, feature FROM range({trees}) AS t(tree), range({width}) AS f(feature)"


def single_tree(names, depth=7, min_split=10):
    """Expressions up to ``tree_nodes`` of one tree with row weight 1."""
    rows = f"SELECT 0 AS tree, customer_id AS id, 1 AS n, 1e0 AS wn, CAST({LABEL} = 1 AS DOUBLE) AS wp FROM dataset"
    return _finished(rows, _all_features(1, len(names)), names, depth, min_split)


def _finished(rows, features, names, depth, min_split):
    nodes = _NODES.format(order="", rows="SELECT g.*, n, wn, wp FROM grown g JOIN tree_rows USING (tree, id)")
    return f"""
  train_values AS MATERIALIZED ({long_rows(names)}),
  tree_rows AS MATERIALIZED ({rows}),
  tree_features AS MATERIALIZED ({features}),
  {_grown(depth, min_split)},
  {nodes}"""


def subsets(width, trees, seed):
    """(tree, position, feature) as the forest draws them."""
    size = forest.subset_size(width)
    return f"""SELECT tree, position, feature FROM (
      SELECT tree, feature, row_number() OVER (
        PARTITION BY tree ORDER BY md5(concat_ws(':', '{seed}', 'feature', tree, feature))) - 1 AS position
      FROM range({trees}) AS t(tree), range({width}) AS f(feature)) d WHERE position < {size}"""


def random_forest(names, draws, seed, trees=forest.TREES, depth=forest.DEPTH, min_split=forest.MIN_SPLIT):
    """Expressions up to ``tree_nodes``; ``draws`` is the statement (customer_id, tree, draws)."""
    rows = f"""SELECT b.tree, b.customer_id AS id, b.draws AS n, b.draws * w AS wn, b.draws * w * y AS wp
      FROM ({draws}) b JOIN (
        SELECT customer_id, y, count(*) OVER () / (2e0 * CASE WHEN y = 1 THEN greatest(sum(y) OVER (), 1)
          ELSE greatest(count(*) OVER () - greatest(sum(y) OVER (), 1), 1) END) AS w
        FROM (SELECT customer_id, CAST({LABEL} = 1 AS INTEGER) AS y FROM dataset) l) c USING (customer_id)"""
    return _finished(rows, subsets(len(names), trees, seed), names, depth, min_split)


def boosted(names, rounds=boosting.ROUNDS, rate=boosting.RATE, depth=boosting.DEPTH, min_split=boosting.MIN_SPLIT):
    """Expressions up to ``tree_nodes``: a recursion over rounds and, within one, levels."""
    weight = "greatest(abs(y - 1e0 / (1e0 + exp(-score))), 0.01e0)"
    here = f"""(SELECT id, path, 1 AS n, {weight} AS wn, {weight} * y AS wp FROM boosted
      WHERE level < {depth} AND length(path) = level)"""
    leaf = f"sum({weight} * y) OVER (PARTITION BY path) / sum({weight}) OVER (PARTITION BY path)"
    nodes = _NODES.format(order="tree,", rows=f"""
      SELECT level, tree, path, feature, threshold, 1 AS n, {weight} AS wn, {weight} * y AS wp
      FROM boosted WHERE length(path) = level AND tree < {rounds}""").replace("GROUP BY tree, level, tree, path", "GROUP BY level, tree, path")
    return f"""
  train_values AS MATERIALIZED ({long_rows(names)}),
  all_features AS MATERIALIZED (SELECT feature AS position, feature FROM range({len(names)}) AS f(feature)),
  prior AS (SELECT ln(greatest(sum(y), 1) / greatest(count(*) - greatest(sum(y), 1), 1)::double) AS base
    FROM (SELECT CAST({LABEL} = 1 AS INTEGER) AS y FROM dataset) l),
  boosted AS (
    SELECT 0 AS tree, 0 AS level, customer_id AS id, CAST({LABEL} = 1 AS DOUBLE) AS y, base AS score, '' AS path,
      CAST(NULL AS INTEGER) AS feature, CAST(NULL AS DOUBLE) AS threshold FROM dataset, prior
    UNION ALL
    SELECT * FROM (
      SELECT g.tree, g.level + 1, g.id, g.y, g.score,
        CASE WHEN b.feature IS NULL THEN g.path WHEN x.v <= b.threshold THEN g.path || '0' ELSE g.path || '1' END,
        coalesce(b.feature, g.feature), coalesce(b.threshold, g.threshold)
      FROM boosted g LEFT JOIN ({_best(here, ["path"], min_split, "all_features")}) b ON b.path = g.path
        LEFT JOIN train_values x ON x.id = g.id AND x.feature = b.feature
      WHERE g.level < {depth} AND g.tree < {rounds}
      UNION ALL
      SELECT tree + 1, 0, id, y, score + {rate!r} * (p - 0.5e0) * 2e0, '', NULL, NULL
      FROM (SELECT *, {leaf} AS p FROM boosted WHERE level = {depth} AND tree < {rounds}) done) step),
  {nodes}"""


def node_table(names):
    return _node_table(names)


def predicted(kind, source="SELECT * FROM dataset", values="train_values"):
    """Expressions up to ``predicted`` (customer_id, p) for the rows of ``source``."""
    if kind == "boosting":
        p = f"""SELECT id AS customer_id, CASE WHEN z >= {boosting.LOGIT_LIMIT!r} THEN 1e0 WHEN z <= -{boosting.LOGIT_LIMIT!r} THEN 0e0
          ELSE 1e0 / (1e0 + exp(-z)) END AS p FROM (
          SELECT id, any_value(base) + sum({boosting.RATE!r} * (probability - 0.5e0) * 2e0) AS z FROM leaves, prior GROUP BY id) l"""
    else:
        p = "SELECT id AS customer_id, avg(probability) AS p FROM leaves GROUP BY id"
    return f"{_walked(source)}, predicted AS ({p})".replace("asked_values", values)


def importance(names):
    """Share of the splits that use each feature."""
    count = " UNION ALL ".join(f"SELECT '{n}' AS feature, {j} AS j" for j, n in enumerate(names))
    return f"""SELECT f.feature, round(count(c.tree) / sum(count(c.tree)) OVER (), 6) AS importance FROM ({count}) f
      LEFT JOIN (SELECT tree, feature_above FROM tree_nodes WHERE path LIKE '%0') c ON c.feature_above = f.j GROUP BY f.feature"""
