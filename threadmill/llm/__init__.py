"""Operators of a training-data pipeline: one module per operator.

Nothing outside this subpackage imports it. Worker code is shipped by value,
so executors need the third-party libraries but not this package.
"""

from threadmill._ship import ship_by_value

ship_by_value(__name__)
