"""monthmill: monthly trip records as one fact, its dimensions, a rollup and the questions asked of them.

Everything is a DataFrame -> DataFrame function; compose with ``df.transform``.
"""
