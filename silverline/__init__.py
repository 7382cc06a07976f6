"""silverline: layered (raw -> bronze -> silver) batch and incremental pipelines on Spark."""

from .contract import MOVIE_CONTRACT, ORDER_CONTRACT, Contract, Rule, TablePaths

__all__ = ["Contract", "Rule", "TablePaths", "MOVIE_CONTRACT", "ORDER_CONTRACT"]
