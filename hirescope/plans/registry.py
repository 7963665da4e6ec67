"""Registered driver queries (name -> Spark job) and their DuckDB oracles."""

from __future__ import annotations

from hirescope.plans import crawl, docs, events, oracle_crawl, postings, reports, stores, web
from hirescope.plans.oracle import ORACLE as _ORACLE

QUERIES = {
    "skill_demand_mart": docs.mart_skill_metrics,
    "dim_skills": docs.dim_skills,
    "bridge_job_skills": docs.bridge_job_skills,
    "top_skills": docs.top_skills,
    "skill_slice": docs.skill_slice,
    "cleaned_postings": postings.cleaned_postings_report,
    "notebook_fields": postings.notebook_fields,
    "notebook_company_drafts": postings.notebook_company_drafts,
    "notebook_categories_skills": postings.notebook_categories_skills,
    "notebook_location_refine": postings.notebook_location_refine,
    "stg_jobs": postings.stg_report,
    "dim_job": postings.dim_job,
    "dim_company": postings.dim_company,
    "dim_location": postings.dim_location,
    "dim_date": postings.dim_date,
    "fact_jobs": postings.fact_jobs,
    "fact_jobs_joined": postings.fact_jobs_joined,
    "job_skill_metrics": postings.skill_metrics,
    "category_metrics": postings.category_metrics,
    "skill_count_per_job": postings.skill_count,
    "skill_count_sql": postings.skill_count_sql,
    "skill_category_crosstab": postings.skill_category,
    "star_integrity": postings.integrity,
    "latest_event_per_user": events.latest_event_per_user,
    "first_event_per_user": events.first_event_per_user,
    "repeated_user_day_type": events.repeated_user_day_type,
    "duplicate_user_count": events.duplicate_user_count,
    "user_event_sequence": events.user_event_sequence,
    "first_type_per_user": events.first_type_per_user,
    "event_props": events.event_props,
    "incremental_events": events.incremental_events,
    "upsert_orders": events.upsert_orders,
    "upsert_order_counts": events.upsert_order_counts,
    "fieldwise_order_update": events.fieldwise_order_update,
    "segment_value_counts": reports.segment_value_counts,
    "priority_status_counts": reports.priority_status_counts,
    "distinct_counts": reports.distinct_counts,
    "parts_per_order_anova": reports.parts_per_order_anova,
    "parts_per_order_by_level": reports.parts_per_order_by_level,
    "segment_correlation": reports.segment_correlation,
    "brand_priority_crosstab": reports.brand_priority_cells,
    "brand_priority_chi_square": reports.brand_priority_chi_square,
    "weekly_velocity": reports.weekly_velocity,
    "monthly_share_change": reports.monthly_share_change,
    "days_to_ship": reports.days_to_ship,
    "top_customers": reports.top_customers,
    "priority_funnel": reports.priority_funnel,
    "part_cooccurrence": reports.part_cooccurrence,
    "page_fields": web.page_fields,
    "page_links": web.page_links,
    "page_url_parts": web.page_url_parts,
    "page_card_fallbacks": web.page_card_fallbacks,
    "doc_text_profile": web.doc_text_profile,
    "conversation_last_lines": web.conversation_last_lines,
    "doc_rule_labels": web.doc_rule_labels,
    "part_company_types": web.part_company_types,
    "text_rule_labels": web.text_rule_labels,
    "rule_arms": web.rule_arms,
    "quality_checks": postings.quality_checks,
    "null_profile": postings.null_profile,
    "raw_completeness": postings.raw_completeness,
    "raw_top_locations": postings.raw_top_locations,
    "model_tests": postings.model_tests,
    "kpis": postings.kpis,
    "raw_top_companies": postings.raw_top_companies,
    "missing_counts": postings.missing_counts,
    "top_skills_per_category": postings.top_skills_per_category,
    "daily_velocity": reports.daily_velocity,
    "hypothesis_tests": reports.hypothesis_test_rows,
    "cleaned_skills_without_bullets": postings.cleaned_skills_without_bullets,
    "postings_by_company_type": postings.postings_by("company_type"),
    "postings_by_city": postings.postings_by("city"),
    "postings_by_job_category": postings.postings_by("job_category"),
    "top_skills_per_level": postings.top_skills_per_level,
    "skill_roadmap": postings.skill_roadmap,
    "audit_profile": postings.audit_profile,
    "level_before_after": postings.level_before_after,
    "empty_skills_share": postings.empty_skills_share,
    "sample_postings": postings.sample_postings,
    "warehouse_load_shape": postings.warehouse_load_shape,
    "new_vs_known_pairs": events.new_vs_known_pairs,
    "page_postings": crawl.page_postings,
    "page_quarantine": crawl.page_quarantine,
    "page_details": crawl.page_details,
    "page_headlines": crawl.page_headlines,
    "upsert_order_files": stores.upsert_order_files,
    "incremental_marts": stores.incremental_marts,
    "stream_postings": stores.stream_postings,
    "quality_offenders": postings.quality_offenders,
    "notebook_combined": postings.notebook_combined,
    "notebook_work_types": postings.notebook_work_types,
    "notebook_governorates": postings.notebook_governorates,
    "job_metrics_ordered": postings.job_metrics_ordered,
    "catalog_counts": stores.catalog_counts,
    "raw_json_roundtrip": stores.raw_json_roundtrip,
    "raw_csv_roundtrip": stores.raw_csv_roundtrip,
    "gate_status": stores.gate_status,
    "audit_report": postings.audit_report,
    "audit_sketches": postings.audit_sketches,
}

ORACLE = {k: v for k, v in {**_ORACLE, **oracle_crawl.ORACLE}.items() if k in QUERIES}
