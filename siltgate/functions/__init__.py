"""Scalar functions as SQL text: every one takes expression text and returns it.

Text composes without a round trip to the JVM per operator, so a rule set of
hundreds of expressions is planned in a fraction of a second; use the result
with ``F.expr`` or ``selectExpr``. Everything stays in built-in functions.
"""
