"""Spark-first analytics for build-farm corpora.

Sub-packages: ``functions`` (column expressions), ``operators`` (DataFrame to
DataFrame), ``sources`` (readers, writers, role views), ``plans`` (the query
catalogue and its SQL twins), ``streaming`` (Structured Streaming jobs).
``llm`` holds the training-data operators; nothing else imports it.
"""

from buildlake.farm import Farm
from buildlake.operators.hooks import accepted, analysed, run_strategy
from buildlake.schemas import FAILED, INIT, OUTDATED, PROCESSING, SUCCESS
from buildlake.sources.crawl import RepositoryCrawl, crawl

__all__ = ["FAILED", "INIT", "OUTDATED", "PROCESSING", "SUCCESS", "Farm", "RepositoryCrawl", "accepted", "analysed", "crawl", "run_strategy"]
