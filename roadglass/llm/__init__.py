"""Operators for large text corpora: cleaning, counting, aligning and packing steps.

Nothing outside this folder imports it. Every operator takes DataFrames and
column names, selects only the columns that it needs, and returns the id column
with its own results, so further columns of the input, whatever their names,
never clash with what an operator adds. Where columns can be carried along, one
with the name of a result is refused. Callers who want others join them by id.
"""
