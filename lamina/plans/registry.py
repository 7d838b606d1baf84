"""All queries of the document engine and their SQL counterparts, by name."""

from __future__ import annotations

from lamina.plans import audit_queries, block_queries, document_queries, fold_sql, kind_queries, model_queries, report_queries, table_queries, text_queries

QUERIES: dict = {**audit_queries.QUERIES, **block_queries.QUERIES, **document_queries.QUERIES, **kind_queries.QUERIES, **model_queries.QUERIES, **report_queries.QUERIES, **table_queries.QUERIES, **text_queries.QUERIES}
ORACLES: dict = {**audit_queries.ORACLES, **block_queries.ORACLES, **document_queries.ORACLES, **fold_sql.ORACLES, **kind_queries.ORACLES, **model_queries.ORACLES, **report_queries.ORACLES, **table_queries.ORACLES, **text_queries.ORACLES}
