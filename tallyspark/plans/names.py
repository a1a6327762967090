"""The tables that an SQL text names, by Spark's own parser."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Classes of Spark's parsed plan that name a table to be looked up, with the field of its name.
_LOOKUPS = {"UnresolvedRelation": "multipartIdentifier",
            "UnresolvedTableOrView": "multipartIdentifier",
            "UnresolvedTable": "multipartIdentifier",
            "UnresolvedView": "multipartIdentifier"}


def _items(seq) -> list:
    it, out = seq.iterator(), []
    while it.hasNext():
        out.append(it.next())
    return out


class _Walk:
    def __init__(self, spark: SparkSession):
        jvm = spark._jvm
        self.kinds = {k: jvm.java.lang.Class.forName(c) for k, c in (
            ("product", "scala.Product"), ("iterable", "scala.collection.Iterable"))}
        self.names: set[tuple[str, ...]] = set()
        self.computed = False       # a name is computed when the text runs: identifier(...)

    def visit(self, node, local: frozenset) -> None:
        """``local``: names that ``with`` defines around the node, in lower case."""
        if node is None or isinstance(node, (str, int, float, bool, bytes)) \
                or not hasattr(node, "getClass"):
            return
        kind = node.getClass().getSimpleName()
        if kind in _LOOKUPS:
            parts = tuple(map(str, _items(getattr(node, _LOOKUPS[kind])())))
            if len(parts) > 1 or parts[0].lower() not in local:
                self.names.add(parts)
            return
        if kind in ("PlanWithUnresolvedIdentifier", "ExpressionWithUnresolvedIdentifier"):
            self.computed = True
        if kind == "UnresolvedWith":
            self._with(node, local)
        elif self.kinds["iterable"].isInstance(node):
            for x in _items(node):
                self.visit(x, local)
        elif self.kinds["product"].isInstance(node):
            for x in _items(type("P", (), {"iterator": node.productIterator})):
                self.visit(x, local)

    def _with(self, node, local: frozenset) -> None:
        """A definition sees those before it (and, if recursive, itself); the rest sees all."""
        recursive = bool(node.allowRecursion())
        for definition in _items(node.cteRelations()):
            parts = _items(type("P", (), {"iterator": definition.productIterator}))
            own = local | {str(parts[0]).lower()}
            for x in parts[1:]:
                self.visit(x, own if recursive else local)
            local = own
        self.visit(node.child(), local)


def named_tables(spark: SparkSession, text: str) -> tuple[set[tuple[str, ...]], bool]:
    """The names (as tuples of their parts) that the text looks up: in ``from``, subqueries,
    definitions of ``with``, ``describe`` and so on; names that ``with`` defines are not looked
    up. The flag says that the text also computes names. A text that Spark cannot parse raises
    Spark's own error."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    walk = _Walk(spark)
    walk.visit(plan, frozenset())
    return walk.names, walk.computed
