"""All queries of this subpackage: name -> callable(spark, sf_dir), and their SQL."""

from __future__ import annotations

from flowgrid.llm import q_link, q_model, q_native, q_scan

QUERIES = {**q_native.QUERIES, **q_scan.QUERIES, **q_model.QUERIES, **q_link.QUERIES}
ORACLES = {**q_native.ORACLES, **q_scan.ORACLES, **q_model.ORACLES, **q_link.ORACLES}
