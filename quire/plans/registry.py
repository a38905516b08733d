"""Registry of queries (name -> callable(spark, sf_dir)) and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.plans import bookkeeping as bk
from quire.plans import (books, catalog, derived_q, feeds, ingest, oracle, oracle_bookkeeping, oracle_catalog, oracle_derived,
                         oracle_feeds, oracle_ingest, oracle_streams, streams)
from quire.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _pinned(q: Query) -> Query:
    """Run ``q`` with the session settings every query relies on (UTC clock)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return q(spark, sf_dir)
    run.__doc__, run.__name__ = q.__doc__, getattr(q, "__name__", "query")
    return run


def queries() -> dict[str, Query]:
    return {name: _pinned(q) for name, q in _queries().items()}


def _queries() -> dict[str, Query]:
    return {
        "onix_scan_project": books.q_onix_scan_project,
        "onix_corrupt_split": books.q_onix_corrupt_split,
        "onix_scan_summary": books.q_onix_scan_summary,
        "book_upsert": books.q_book_upsert,
        "book_id_lookup": books.q_book_id_lookup,
        "needs_embedding": books.q_needs_embedding,
        "soft_delete_reactivate": books.q_soft_delete,
        "feed_manifest": feeds.q_feed_manifest,
        "done_gate": feeds.q_done_gate,
        "framed_csv_inventory": feeds.q_framed_csv_inventory,
        "framed_csv_summary": feeds.q_framed_csv_summary,
        "unframed_csv_avail": feeds.q_unframed_csv_avail,
        "onix_parse_scalars": feeds.q_onix_parse_scalars,
        "isbn_filter": feeds.q_isbn_filter,
        "feed_dates": feeds.q_feed_dates,
        "promotions_upsert": feeds.q_promotions_upsert,
        "multiline_csv": feeds.q_multiline_csv,
        "mark_and_sweep": feeds.q_mark_and_sweep,
        "firm_sale_upsert": feeds.q_firm_sale_upsert,
        "isbn_slips": feeds.q_isbn_slips,
        "restrictions_upsert": feeds.q_restrictions_upsert,
        "regions_upsert": feeds.q_regions_upsert,
        "book_id_backfill": feeds.q_book_id_backfill,
        "unclaimed_files": bk.q_unclaimed_files,
        "ledger_claim": bk.q_ledger_claim,
        "unprocessed_files": bk.q_unprocessed_files,
        "trigger_guard": bk.q_trigger_guard,
        "job_progress": bk.q_job_progress,
        "job_detail": bk.q_job_detail,
        "job_page": bk.q_job_page,
        "latest_full_file": bk.q_latest_full_file,
        "resume_plan": bk.q_resume_plan,
        "resume_chunks": bk.q_resume_chunks,
        "retention_plan": bk.q_retention_plan,
        "ledger_transitions": bk.q_ledger_transitions,
        "replay_guard": bk.q_replay_guard,
        "excerpt_upsert": bk.q_excerpt_upsert,
        "excerpt_counts": bk.q_excerpt_counts,
        "excerpt_watermark": bk.q_excerpt_watermark,
        "authors_lookup_text": bk.q_authors_lookup_text,
        "cover_candidates": bk.q_cover_candidates,
        "cover_outcome_counts": bk.q_cover_outcome_counts,
        "keys_and_urls": bk.q_keys_and_urls,
        "cover_archive_index": bk.q_cover_archive_index,
        "onix_measure_pivot": catalog.q_onix_measure_pivot,
        "child_replace": catalog.q_child_replace,
        "genres_upsert": catalog.q_genres_upsert,
        "book_genres_replace": catalog.q_book_genres_replace,
        "embedding_text": catalog.q_embedding_text,
        "backfill_text": catalog.q_backfill_text,
        "embed_writeback": catalog.q_embed_writeback,
        "stock_gated_merge": catalog.q_stock_gated_merge,
        "stock_gated_merge_group": catalog.q_stock_gated_merge_group,
        "quarantine": catalog.q_quarantine,
        "cosine_topk": catalog.q_cosine_topk,
        "cosine_cells": catalog.q_cosine_cells,
        "fts_rank": catalog.q_fts_rank,
        "stored_search": catalog.q_stored_search,
        "stemmed_search": catalog.q_stemmed_search,
        "trigram_title": catalog.q_trigram_title,
        "key_lookups": catalog.q_key_lookups,
        "stored_lookups": catalog.q_stored_lookups,
        "vector_codec": catalog.q_vector_codec,
        "text_vector_stats": catalog.q_text_vector_stats,
        "onix_ingest": streams.q_onix_ingest,
        "stream_onix_merge": streams.q_stream_onix_merge,
        "stream_stock_merge": streams.q_stream_stock_merge,
        "bootstrap_status": streams.q_bootstrap_status,
        "ingest_tables": ingest.q_ingest_tables,
        "isbn_moves": ingest.q_isbn_moves,
        "region_sellability": derived_q.q_region_sellability,
        "redirect_resolution": derived_q.q_redirect_resolution,
        "stock_zero_fill": derived_q.q_stock_zero_fill,
    }


def oracle_sql() -> dict[str, str]:
    return {**oracle.oracles(), **oracle_feeds.oracles(), **oracle_bookkeeping.oracles(),
            **oracle_catalog.oracles(), **oracle_streams.oracles(),
            **oracle_derived.oracles(), **oracle_ingest.oracles()}
