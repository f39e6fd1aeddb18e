"""Sample lines of a file, for tests."""

HEADER = (
    "meter_id,period_start,period_end,reading_start_kwh,reading_end_kwh,consumption_kwh,"
    "estimated_annual_kwh,subscription_cost_sek,transmission_cost_sek,energy_tax_sek,"
    "grid_vat_sek,grid_total_sek,electricity_cost_sek,electricity_annual_fee_sek,"
    "electricity_vat_sek,electricity_total_sek,total_cost_sek"
)
LINE = (
    "home-01,2026-06-01,2026-06-30,3575,3649,74,943,161.10,26.34,26.64,53.52,267.60,"
    "61.35,31.56,23.23,116.14,383.74"
)
