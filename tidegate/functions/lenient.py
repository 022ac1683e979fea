"""SQL text whose errors are nulls, whatever the session's ANSI mode.

The text is resolved by the session as it is, so types and functions are the user's.  In the resolved
expression every operation that can fail then takes its ``try_`` form: a cast that does not work, a
division by zero, an overflow or an index out of range gives null.  No setting is changed on the way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column

# Arguments by which an expression of Spark says that it raises, and integral types by their SQL names.
_RAISES = ("failOnError", "ansiEnabled")
_INTEGRAL = ("TINYINT", "SMALLINT", "INT", "BIGINT")
# These know no try mode in Spark; without ANSI mode a division by zero is null.
_ANSI_OR_NOT = ("IntegralDivide", "Pmod")


def errors_as_null(df: DataFrame, text: str) -> Column:
    """The expression ``text`` over ``df`` as a column that is null where evaluating it fails.

    Overflows are null in either mode (but for the least BIGINT ``div -1``); other failures of a session without ANSI mode are null by themselves.  Expressions
    with window functions, which Spark takes apart, and subqueries are left as they are, and so is what raises in either
    mode (``to_number``, index 0 of ``element_at``): there the text can name the ``try_`` form.
    """
    column = F.expr(text)
    jvm = df.sparkSession._jvm
    found = df.select(column.alias("_expression"))._jdf.queryExecution().analyzed().expressions().head()
    if found.getClass().getSimpleName() != "Alias":
        return column
    rewritten = _Rewriter(jvm, df.sparkSession.sparkContext._gateway).lenient(found.child())
    return Column(jvm.org.apache.spark.sql.classic.ExpressionUtils.column(rewritten))


class _Rewriter:
    def __init__(self, jvm, gateway):
        self.jvm, self.gateway = jvm, gateway
        self.expressions = jvm.org.apache.spark.sql.catalyst.expressions
        self.attempt = self.expressions.EvalMode.TRY()

    def lenient(self, node):
        children = _listed(node.children())
        if not children:
            return node
        new = [self.lenient(c) for c in children]
        if any(not a.equals(b) for a, b in zip(children, new)):
            node = node.withNewChildren(self.jvm.PythonUtils.toSeq(new))
        kind = node.getClass().getSimpleName()
        if kind in ("UnaryMinus", "Abs") and node.dataType().sql() in _INTEGRAL:
            return self._negation(node.child(), kind)
        return self._attempted(node)

    def _attempted(self, node):
        args, changed = [], False
        kind = node.getClass().getSimpleName()
        names = _listed(node.productElementNames())
        for i, name in enumerate(names):
            value = node.productElement(i)
            if name in _RAISES and value is True:
                value, changed = False, True
            elif name == "evalMode" and value.toString() == "ANSI":
                value, changed = self.attempt, True
            elif name == "evalContext":
                mode = self.expressions.EvalMode.LEGACY() if kind in _ANSI_OR_NOT else self.attempt
                value, changed = self.expressions.NumericEvalContext(mode, value.allowDecimalPrecisionLoss()), True
            args.append(value)
        if not changed:
            return node
        array = self.gateway.new_array(self.jvm.java.lang.Object, len(args))
        for i, value in enumerate(args):
            array[i] = value
        return node.makeCopy(array)

    def _negation(self, child, kind):
        """``-x`` and ``abs(x)`` of whole numbers: the least one has no opposite."""
        zero = self.expressions.Literal.default(child.dataType())
        minus = self.expressions.Subtract(zero, child, self.expressions.NumericEvalContext(self.attempt, True))
        if kind == "UnaryMinus":
            return minus
        return self.expressions.If(self.expressions.LessThan(child, zero), minus, child)


def _listed(seq) -> list:
    """A Scala sequence or iterator as a list."""
    out, each = [], seq.iterator()
    while each.hasNext():
        out.append(each.next())
    return out
