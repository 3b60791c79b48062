"""ledgerline: layered loan-portfolio data operators expressed as Spark plans.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a small
driver-side helper that launches a Spark job).  Nothing here executes rows in
Python except the text-model hook :func:`ledgerline.operators.prompts.generate`.

The names below are the public surface; submodules hold the rest.
"""

from ledgerline.functions import (decode, fill_template, mask_text, money, month_date, safe_cast,
                                  safe_double, safe_int, strip_cast, tier)
from ledgerline.operators.aggregate import regroup, share, summarise, top_k
from ledgerline.operators.changes import (apply_change_set, before_after, change_log, feed_history, gold_refresh,
                                          group_sums, image_sums, latest_changes, lookup_ranged, merge_ranged,
                                          merge_update, read_ranged, replay_changes, start_feed, visible_images,
                                          visible_log, write_ranged)
from ledgerline.operators.filters import keep_in, ordered_subset, require
from ledgerline.operators.policy import masked_view, region_policy, row_policy
from ledgerline.operators.prompts import (cost_by_version, estimate_tokens, generate, narrate_segments,
                                          render_prompts, token_cost, version_compare, write_cost_log)
from ledgerline.operators.quality import (expectation_report, layer_counts, observe_expectations,
                                          reconcile, source_shape)
from ledgerline.plans.chains import (declarative_gold, declarative_silver, loan_chain, loan_gold,
                                     loan_silver, mortgage_chain, mortgage_gold, mortgage_silver,
                                     run_loan_chain, run_mortgage_chain)
from ledgerline.session import build_session, checkpoint_root, scratch_path
from ledgerline.sources.files import (export_manifest, export_parquet, export_tables, read_layer,
                                      read_raw_csv, verify_export, write_csv, write_layer)
from ledgerline.streaming.running import (prefix_aggregate,
                                          run_available_now)

__version__ = "0.1.0"

__all__ = [
    "apply_change_set", "before_after", "build_session", "feed_history", "gold_refresh", "group_sums", "image_sums",
    "lookup_ranged", "merge_ranged", "read_ranged", "start_feed", "visible_images", "visible_log", "write_ranged",
    "change_log", "checkpoint_root", "cost_by_version", "declarative_gold", "declarative_silver",
    "decode", "estimate_tokens", "expectation_report", "export_manifest", "export_parquet",
    "export_tables", "fill_template", "generate", "keep_in", "latest_changes",
    "layer_counts", "loan_chain", "loan_gold", "loan_silver", "mask_text", "masked_view",
    "merge_update", "money", "month_date", "mortgage_chain", "mortgage_gold", "mortgage_silver",
    "narrate_segments", "observe_expectations", "ordered_subset", "prefix_aggregate", "read_layer",
    "read_raw_csv", "reconcile", "region_policy", "regroup", "render_prompts", "replay_changes",
    "require", "row_policy", "run_available_now", "run_loan_chain", "run_mortgage_chain",
    "safe_cast", "safe_double", "safe_int", "scratch_path", "share",
    "source_shape", "strip_cast", "summarise", "tier", "token_cost", "top_k", "verify_export",
    "version_compare", "write_cost_log", "write_csv", "write_layer",
]
