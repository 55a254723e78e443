"""The corpus queries and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from . import bpe, licenses, media, merkle, neardup, packing, quality, repeats, unigram, url_filter


def queries() -> dict:
    return {
        "op1_suffix_dedup": repeats.op1_suffix_dedup,
        "op2_bpe": bpe.op2_bpe,
        "op3_media": media.op3_media,
        "op4_quality": quality.op4_quality,
        "op5_url_filter": url_filter.op5_url_filter,
        "op6_token_counts": unigram.op6_token_counts,
        "op7_license_scan": licenses.op7_license_scan,
        "license_forms": licenses.known_forms,
        "op8_packing": packing.op8_packing,
        "pack_turns": packing.pack_turns,
        "op9_near_duplicates": neardup.op9_near_duplicates,
        "op10_fingerprints": merkle.op10_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_url_filter": url_filter.ORACLE, "op7_license_scan": licenses.ORACLE, "license_forms": licenses.FORMS_ORACLE, "op10_fingerprints": merkle.ORACLE}
