"""DuckDB SQL oracles for the driver's correctness gate.

Written independently of the Spark code (plain SQL over the driver's views),
so a match means two implementations agree.
"""
