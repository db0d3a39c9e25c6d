"""The lines of the report, stated a second time for the oracles of ``q_report``.

One row a line, in display order:
section | label | format | rule | compared with | value | numerator | denominator [| churn channel]
A line without a source has its state in the place of the rule and ends there.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# The report's layout.
_LINES = """
main_metrics_top | % Lead Penetration | percent | missing_source
main_metrics_top | Total Available Stores | integer | last_value | - | total_available_stores | - | -
main_metrics_top | Net Available Adds | integer | additive | - | net_available_adds | - | -
main_metrics_top | Total Active Stores | integer | last_value | - | total_active_stores | - | -
main_metrics_top | % Activation Rate | percent | weighted_ratio | - | activation_rate_pct | new_active | new_available
main_metrics_top | Net Active Adds | integer | additive | - | net_active_adds | - | -
main_metrics_bottom | New Available Stores | integer | additive | - | new_available_stores | - | -
main_metrics_bottom | New Active Stores | integer | additive | - | new_active_stores | - | -
main_metrics_bottom | New Inflow Active Rate | percent | weighted_ratio | - | new_inflow_active_rate_pct | new_active_stores | new_available_stores
hunting | Total New Available Stores Hunting | integer | additive | - | new_available | - | -
hunting | Target Total New Available Stores Hunting | integer | additive | Total New Available Stores Hunting | target_new_available | - | -
hunting | Total Hunting Store_Created | integer | additive | - | store_created | - | -
hunting | Target Hunting Store_Created | number | additive | Total Hunting Store_Created | target_store_created | - | -
hunting | Total Hunting Productivity | number | weighted_productivity | - | productivity | stores_real | dias_real
hunting | Target Hunting Productivity | number | weighted_productivity | Total Hunting Productivity | target_productivity | target_store_created | dias_trabajados_reales_total
hunting | % New Signings Perfect Stores | percent | funnel_ratio_qtd | - | pct_perfect_stores | perfect_stores | store_created
hunting | Total Hunting Headcount | number | avg | - | headcount | - | -
hunting | Target Hunting Headcount | number | avg | Total Hunting Headcount | target_headcount | - | -
hunting | % Hunters Old | percent | weighted_ratio | - | pct_old | senior_headcount | headcount
hunting | % Target Hunters Old | percent | weighted_ratio | % Hunters Old | pct_target_old | target_senior_headcount | target_headcount
hunting | % Handoff done <= 3 days | percent | funnel_ratio_qtd | - | pct_handoff_3d | handoff_3 | store_created
hunting | % Handoff / Signings (Closed cohort) - 7D | percent | funnel_ratio_qtd | - | pct_handoff_7d | handoff_7 | store_created
hunting | % First_Log_in rate (Closed cohort) - 7D | percent | funnel_ratio_qtd | - | pct_login_7d | log_7 | store_created
hunting | Avg days from Signing to Handoff | number | avg | - | avg_dias_handoff | - | -
hunting | Avg days from Signing to Log_in | number | avg | - | avg_dias_log | - | -
hunting | Avg days from Log_in to First_Order | number | avg | - | avg_dias_order | - | -
hunting | % Handoff / Signings (Closed cohort) - 28D | percent | funnel_ratio_qtd | - | pct_handoff_28d | handoff_28 | store_created
hunting | % First_Log_in rate (Closed cohort) - 28D | percent | funnel_ratio_qtd | - | pct_login_28d | log_28 | store_created
hunting | % First_order rate (Closed cohort) | percent | funnel_ratio_qtd | - | pct_first_order | order_28 | store_created
inside_sales_outbound | Total New Available Stores Inside Sales Outbound | integer | additive | - | new_available | - | -
inside_sales_outbound | Target Total New Available Stores Inside Sales Outbound | integer | additive | Total New Available Stores Inside Sales Outbound | target_new_available | - | -
inside_sales_outbound | Total Inside Sales Outbound Store_Created | integer | additive | - | store_created | - | -
inside_sales_outbound | Target Inside Sales Outbound Store_Created | number | additive | Total Inside Sales Outbound Store_Created | target_store_created | - | -
inside_sales_outbound | Total Inside Sales Outbound Productivity | number | weighted_productivity | - | productivity | stores_real | dias_real
inside_sales_outbound | Target Inside Sales Outbound Productivity | number | weighted_productivity | Total Inside Sales Outbound Productivity | target_productivity | target_store_created | dias_trabajados_reales_total
inside_sales_outbound | % New Signings Perfect Stores | percent | funnel_ratio_qtd | - | pct_perfect_stores | perfect_stores | store_created
inside_sales_outbound | Total Inside Sales Outbound Headcount | number | avg | - | headcount | - | -
inside_sales_outbound | Target Inside Sales Outbound Headcount | number | avg | Total Inside Sales Outbound Headcount | target_headcount | - | -
inside_sales_outbound | % Agents Old | percent | weighted_ratio | - | pct_old | senior_headcount | headcount
inside_sales_outbound | % Target Agents Old | percent | weighted_ratio | % Agents Old | pct_target_old | target_senior_headcount | target_headcount
inside_sales_outbound | % Handoff done <= 3 days | percent | funnel_ratio_qtd | - | pct_handoff_3d | handoff_3 | store_created
inside_sales_outbound | % Handoff / Signings (Closed cohort) - 7D | percent | funnel_ratio_qtd | - | pct_handoff_7d | handoff_7 | store_created
inside_sales_outbound | % First_Log_in rate (Closed cohort) - 7D | percent | funnel_ratio_qtd | - | pct_login_7d | log_7 | store_created
inside_sales_outbound | Avg days from Signing to Handoff | number | avg | - | avg_dias_handoff | - | -
inside_sales_outbound | Avg days from Signing to Log_in | number | avg | - | avg_dias_log | - | -
inside_sales_outbound | Avg days from Log_in to First_Order | number | avg | - | avg_dias_order | - | -
inside_sales_outbound | % Handoff / Signings (Closed cohort) - 28D | percent | funnel_ratio_qtd | - | pct_handoff_28d | handoff_28 | store_created
inside_sales_outbound | % First_Log_in rate (Closed cohort) - 28D | percent | funnel_ratio_qtd | - | pct_login_28d | log_28 | store_created
inside_sales_outbound | % First_order rate (Closed cohort) | percent | funnel_ratio_qtd | - | pct_first_order | order_28 | store_created
inside_sales_inbound | Total New Available Stores Inside Sales Inbound | integer | additive | - | new_available | - | -
inside_sales_inbound | Target Total New Available Stores Inside Sales Inbound | integer | additive | Total New Available Stores Inside Sales Inbound | target_new_available | - | -
inside_sales_inbound | Target Inbound Verified Leads | integer | missing_source
inside_sales_inbound | Total Inside Sales Inbound Store_Created | integer | additive | - | store_created | - | -
inside_sales_inbound | Target Inside Sales Inbound Store_Created | number | additive | Total Inside Sales Inbound Store_Created | target_store_created | - | -
inside_sales_inbound | Total Inside Sales Inbound Productivity | number | weighted_productivity | - | productivity | stores_real | dias_real
inside_sales_inbound | Target Inside Sales Inbound Productivity | number | weighted_productivity | Total Inside Sales Inbound Productivity | target_productivity | target_store_created | dias_trabajados_reales_total
inside_sales_inbound | % New Signings Perfect Stores | percent | funnel_ratio_qtd | - | pct_perfect_stores | perfect_stores | store_created
inside_sales_inbound | Total Inside Sales Inbound Headcount | number | avg | - | headcount | - | -
inside_sales_inbound | Target Inside Sales Inbound Headcount | number | avg | Total Inside Sales Inbound Headcount | target_headcount | - | -
inside_sales_inbound | % Agents Old | percent | weighted_ratio | - | pct_old | senior_headcount | headcount
inside_sales_inbound | % Target Agents Old | percent | weighted_ratio | % Agents Old | pct_target_old | target_senior_headcount | target_headcount
inside_sales_inbound | % Handoff done <= 3 days | percent | funnel_ratio_qtd | - | pct_handoff_3d | handoff_3 | store_created
inside_sales_inbound | % Handoff / Signings (Closed cohort) - 7D | percent | funnel_ratio_qtd | - | pct_handoff_7d | handoff_7 | store_created
inside_sales_inbound | % First_Log_in rate (Closed cohort) - 7D | percent | funnel_ratio_qtd | - | pct_login_7d | log_7 | store_created
inside_sales_inbound | Avg days from Signing to Handoff | number | avg | - | avg_dias_handoff | - | -
inside_sales_inbound | Avg days from Signing to Log_in | number | avg | - | avg_dias_log | - | -
inside_sales_inbound | Avg days from Log_in to First_Order | number | avg | - | avg_dias_order | - | -
inside_sales_inbound | % Handoff / Signings (Closed cohort) - 28D | percent | funnel_ratio_qtd | - | pct_handoff_28d | handoff_28 | store_created
inside_sales_inbound | % First_Log_in rate (Closed cohort) - 28D | percent | funnel_ratio_qtd | - | pct_login_28d | log_28 | store_created
inside_sales_inbound | % First_order rate (Closed cohort) | percent | funnel_ratio_qtd | - | pct_first_order | order_28 | store_created
self_onboarding | Total New Available Stores Self Onboarding | integer | additive | - | new_available | - | -
self_onboarding | Target Total New Available Stores Self Onboarding | integer | additive | Total New Available Stores Self Onboarding | target_new_available | - | -
self_onboarding | Total Self Onboarding Store_Created | integer | missing_source
self_onboarding | Target Self Onboarding Store_Created | integer | missing_source
self_onboarding | VL Leads | integer | missing_source
self_onboarding | VL Leads Target | integer | missing_source
self_onboarding | Conv E2E | percent | pending_definition
brand_expansion | Total New Available Stores Brand Expansion | integer | additive | - | new_available | - | -
brand_expansion | Target Total New Available Stores Brand Expansion | integer | additive | Total New Available Stores Brand Expansion | target_new_available | - | -
brand_expansion | Total Brand Expansion Store_Created | integer | additive | - | store_created | - | -
brand_expansion | Target Brand Expansion Store_Created | integer | missing_source
brand_expansion | % First_Log_in rate (Closed cohort) | percent | missing_source
brand_expansion | % First_order rate (Closed cohort) | percent | missing_source
early_churn_m1 | % Churn Hunting | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | HUNTING
early_churn_m1 | Target % Churn Hunting | percent | weighted_ratio | % Churn Hunting | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | HUNTING
early_churn_m1 | % Churn Inside Sales | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | IS
early_churn_m1 | Target % Churn Inside Sales | percent | weighted_ratio | % Churn Inside Sales | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | IS
early_churn_m1 | % Churn Self-Onboarding | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | SOB
early_churn_m1 | Target % Churn Self-Onboarding | percent | weighted_ratio | % Churn Self-Onboarding | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | SOB
early_churn_m1 | % Churn Brand Expansion | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | BE
early_churn_m1 | Target % Churn Brand Expansion | percent | weighted_ratio | % Churn Brand Expansion | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | BE
early_churn_m1 | % Churn Total | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | TOTAL
early_churn_m1 | Target % Churn Total | percent | weighted_ratio | % Churn Total | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | TOTAL
early_churn_m2 | % Churn Hunting | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | HUNTING
early_churn_m2 | Target % Churn Hunting | percent | weighted_ratio | % Churn Hunting | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | HUNTING
early_churn_m2 | % Churn Inside Sales | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | IS
early_churn_m2 | Target % Churn Inside Sales | percent | weighted_ratio | % Churn Inside Sales | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | IS
early_churn_m2 | % Churn Self-Onboarding | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | SOB
early_churn_m2 | Target % Churn Self-Onboarding | percent | weighted_ratio | % Churn Self-Onboarding | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | SOB
early_churn_m2 | % Churn Brand Expansion | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | BE
early_churn_m2 | Target % Churn Brand Expansion | percent | weighted_ratio | % Churn Brand Expansion | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | BE
early_churn_m2 | % Churn Total | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | TOTAL
early_churn_m2 | Target % Churn Total | percent | weighted_ratio | % Churn Total | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | TOTAL
early_churn_m3 | % Churn Hunting | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | HUNTING
early_churn_m3 | Target % Churn Hunting | percent | weighted_ratio | % Churn Hunting | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | HUNTING
early_churn_m3 | % Churn Inside Sales | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | IS
early_churn_m3 | Target % Churn Inside Sales | percent | weighted_ratio | % Churn Inside Sales | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | IS
early_churn_m3 | % Churn Self-Onboarding | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | SOB
early_churn_m3 | Target % Churn Self-Onboarding | percent | weighted_ratio | % Churn Self-Onboarding | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | SOB
early_churn_m3 | % Churn Brand Expansion | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | BE
early_churn_m3 | Target % Churn Brand Expansion | percent | weighted_ratio | % Churn Brand Expansion | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | BE
early_churn_m3 | % Churn Total | percent | weighted_ratio | - | churn_pct | churn_stores | total_stores | TOTAL
early_churn_m3 | Target % Churn Total | percent | weighted_ratio | % Churn Total | target_pct | target_pct * total_stores | CASE WHEN target_pct IS NOT NULL THEN total_stores END | TOTAL
"""
# ---------------------------------------------------------------------------


def report_lines() -> list[dict]:
    """Section, place in it, label, format, rule, line compared with, state, value, parts and channel of every line."""
    out, places = [], {}
    for row in _LINES.strip().split("\n"):
        section, label, fmt, rule, *rest = (None if x == "-" else x for x in row.split(" | "))
        against, value, num, den, channel = [*rest, *[None] * (5 - len(rest))]
        places[section] = places.get(section, 0) + 1
        state = rule if rule in ("missing_source", "pending_definition") else None
        out.append({"section_id": section, "seq": places[section], "label": label, "format": fmt, "qtd_rule": None if state else rule,
                    "gap_against": against, "render_as": state, "invert_gap": channel is not None and against is not None,
                    "is_churn_total": channel == "TOTAL", "value": value, "num": num, "den": den, "channel": channel})
    return out
