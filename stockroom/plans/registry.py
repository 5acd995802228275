"""Query key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from . import books, brief, explore, history, lists, matching, order, sales, streams, uploads, vendors, weekly

QUERIES = {
    "reorder_need": order.q_reorder_need,
    "transfer_plan": order.q_transfer_plan,
    "transfer_items": order.q_transfer_items,
    "transfer_plan_ranked": order.q_transfer_plan_ranked,
    "store_orders": order.q_store_orders,
    "weekly_order": weekly.q_weekly_order,
    "needs_review": weekly.q_needs_review,
    "being_removed": weekly.q_being_removed,
    "buy_month_wait": weekly.q_buy_month_wait,
    "budget_prefix": weekly.q_budget_prefix,
    "weekly_order_overrides": weekly.q_weekly_order_overrides,
    "rank_margin": weekly.q_rank_margin,
    "rank_deals": weekly.q_rank_deals,
    "rank_balanced": weekly.q_rank_balanced,
    "dept_summary": weekly.q_dept_summary,
    "src_history": history.q_src_history,
    "full_months": history.q_full_months,
    "category_seasonality": history.q_category_seasonality,
    "item_seasonality": history.q_item_seasonality,
    "item_month_index": history.q_item_month_index,
    "event_lift": history.q_event_lift,
    "yoy_growth": history.q_yoy_growth,
    "true_velocity": history.q_true_velocity,
    "buy_ahead": history.q_buy_ahead,
    "seasonal_factors": history.q_seasonal_factors,
    "restock_brief": brief.q_restock_brief,
    "pricing_flags": brief.q_pricing_flags,
    "deal_evaluation": brief.q_deal_evaluation,
    "inventory_snapshot": brief.q_inventory_snapshot,
    "chain_by_code": brief.q_chain_by_code,
    "live_rollup": sales.q_live_rollup,
    "open_po_report": sales.q_open_po_report,
    "open_po_wine": sales.q_open_po_wine,
    "sink_vendor_split": sales.q_sink_vendor_split,
    "freshness": sales.q_freshness,
    "vendor_rollup": vendors.q_vendor_rollup,
    "store_vendor_rollup": vendors.q_store_vendor_rollup,
    "store_receiving_rollup": vendors.q_store_receiving_rollup,
    "headline_kpis": vendors.q_headline_kpis,
    "vendor_order": vendors.q_vendor_order,
    "store_order": vendors.q_store_order,
    "sheet_compare": matching.q_sheet_compare,
    "sheet_compare_summary": matching.q_sheet_compare_summary,
    "ad_order": matching.q_ad_order,
    "ad_order_unmatched": matching.q_ad_order_unmatched,
    "mtd_kpis": explore.q_mtd_kpis,
    "category_sales": explore.q_category_sales,
    "low_margin_top_sellers": explore.q_low_margin_top_sellers,
    "top_sellers": explore.q_top_sellers,
    "top_profit": explore.q_top_profit,
    "needs_attention_stockouts": explore.q_needs_attention_stockouts,
    "needs_attention_above_market": explore.q_needs_attention_above_market,
    "focus_low_wos": explore.q_focus_low_wos,
    "focus_deals": explore.q_focus_deals,
    "focus_items": explore.q_focus_items,
    "focus_store_detail": explore.q_focus_store_detail,
    "list_explore": explore.q_list_explore,
    "list_explore_indexed": explore.q_list_explore_indexed,
    "list_search": explore.q_list_search,
    "list_facets": explore.q_list_facets,
    "fit_budget": explore.q_fit_budget,
    "right_size": explore.q_right_size,
    "right_size_candidates": explore.q_right_size_candidates,
    "decision_state": explore.q_decision_state,
    "stream_live_sales": streams.q_stream_live_sales,
    "stream_live_lines": streams.q_stream_live_lines,
    "stream_history": streams.q_stream_history,
    "stream_decisions": streams.q_stream_decisions,
    "stream_decision_refusals": streams.q_stream_decision_refusals,
    "ledger_history": streams.q_ledger_history,
    "stream_live_days": streams.q_stream_live_days,
    "category_report": lists.q_category_report,
    "row_flags": lists.q_row_flags,
    "po_import": lists.q_po_import,
    "po_import_summary": lists.q_po_import_summary,
    "cost_reference": lists.q_cost_reference,
    "ad_week_items": lists.q_ad_week_items,
    "report_items": lists.q_report_items,
    "report_lines": lists.q_report_lines,
    "ad_sheet_blocks": lists.q_ad_sheet_blocks,
    "upload_compare": uploads.q_upload_compare,
    "upload_money": uploads.q_upload_money,
    "buyer_master": uploads.q_buyer_master,
    "tidy_tab": uploads.q_tidy_tab,
    "tab_items": uploads.q_tab_items,
    "report_files": uploads.q_report_files,
    "newest_snapshot": uploads.q_newest_snapshot,
    "explore_filtered": uploads.q_explore_filtered,
    "store_orders_written": uploads.q_store_orders_written,
    "vendor_split_files": sales.q_vendor_split_files,
    "price_reference": books.q_price_reference,
    "book_headers": books.q_book_headers,
    "book_inventory": books.q_book_inventory,
    "book_tab_items": books.q_book_tab_items,
    "book_columns": books.q_book_columns,
    "ad_days": books.q_ad_days,
    "ad_week_sales": books.q_ad_week_sales,
}
