"""Fixed schemas of the relational tables that a registry record becomes.

Fixed values: table and column names and types of the registry's data model.
"""

from __future__ import annotations

from pyspark.sql import types as T

LINEAGE = "file_dt_source date, file_name_source string"

_CASE_FILE = """
serial_no string, registration_no string, mark_id_char string, filing_dt date, registration_dt date, publication_dt date, abandon_dt date,
cancel_cd string, cancel_dt date, cancel_pend_in boolean, renewal_dt date, renewal_file_in boolean, status_cd string, status_dt date,
mark_draw_cd string, std_char_claimed_in boolean, attorney_name string, atty_dkt_no string, domestic_rep_name string, exm_name string,
exm_office_cd string, file_location string, file_location_dt date, use_af_in boolean, use_intent_in boolean, for_app_in boolean,
for_reg_in boolean, intl_reg_in boolean, no_basis_in boolean, use_file_in boolean, use_intent_file_in boolean, for_app_file_in boolean,
for_reg_file_in boolean, intl_reg_file_in boolean, no_basis_file_in boolean, amend_reg_dt date, amend_lb_use_in boolean,
amend_lb_itu_in boolean, amend_lb_for_app_in boolean, amend_lb_for_reg_in boolean, amend_principal_in boolean, amend_supp_reg_in boolean,
chg_reg_in boolean, opposition_pend_in boolean, interference_pend_in boolean, concur_use_in boolean, concur_use_pend_in boolean,
concur_use_pub_in boolean, use_afdv_file_in boolean, use_afdv_acc_in boolean, use_afdv_par_acc_in boolean, incontest_file_in boolean,
incontest_ack_in boolean, acq_dist_in boolean, acq_dist_part_in boolean, repub_12c_in boolean, repub_12c_dt date,
draw_color_file_in boolean, draw_color_cur_in boolean, draw_3d_file_in boolean, draw_3d_cur_in boolean, for_priority_in boolean,
ir_no string, ir_registration_dt date, ir_publication_dt date, ir_renewal_dt date, ir_death_dt date, ir_status_cd string, ir_status_dt date,
ir_auto_reg_dt date, ir_first_refus_in boolean, ir_priority_in boolean, ir_priority_dt date, supp_reg_in boolean, certification_in boolean,
collective_in boolean, coll_serv_mark_in boolean, coll_trade_mark_in boolean, service_in boolean, trade_in boolean, related_other_in boolean
"""

_COLUMNS = {
    "case_file": _CASE_FILE,
    "owner": "serial_no string, own_seq int, own_type_cd string, own_name string, own_altn_name string, own_entity_cd string, own_entity_desc string, own_composed_of string, own_addr_1 string, own_addr_2 string, own_addr_city string, own_addr_state_cd string, own_addr_postal string, own_addr_country_cd string, own_addr_other_cd string, own_nalty_country_cd string, own_nalty_state_cd string, own_nalty_other_cd string",
    "classification": "serial_no string, class_seq int, primary_cd string, class_status_cd string, class_status_dt date, class_intl_count int, class_us_count int, use_first_anywhere_dt date, use_first_commerce_dt date, use_first_anywhere_raw string, use_first_commerce_raw string",
    "intl_class": "serial_no string, class_seq int, intl_class_cd string",
    "us_class": "serial_no string, class_seq int, us_class_cd string",
    "statement": "serial_no string, statement_seq int, statement_type_cd string, statement_text string",
    "event": "serial_no string, event_seq int, event_cd string, event_type_cd string, event_dt date",
    "design_search": "serial_no string, design_search_cd string",
    "prior_mark": "serial_no string, prior_no string, prior_type_cd string",
    "foreign_app": "serial_no string, foreign_seq int, for_country_cd string, for_other string, for_app_no string, for_app_dt date, for_reg_no string, for_reg_dt date, for_reg_exp_dt date, for_renewal_no string, for_renewal_dt date, for_renewal_exp_dt date, for_priority_claim_in boolean",
    "madrid_intl_file": "serial_no string, madrid_seq int, madrid_ref_no string, madrid_orig_filing_dt date, ir_no string, ir_dt date, madrid_status_cd string, madrid_status_dt date, irregularity_reply_by_dt date, ir_renewal_dt date",
    "owner_name_change": "serial_no string, change_seq int, change_text string",
    "correspondent": "serial_no string, cor_addr_1 string, cor_addr_2 string, cor_addr_3 string, cor_addr_4 string, cor_addr_5 string",
}

def _parse(ddl: str) -> T.StructType:
    kinds = {"string": T.StringType(), "date": T.DateType(), "boolean": T.BooleanType(), "int": T.IntegerType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (c.split() for c in ddl.split(","))])


TABLES: dict[str, T.StructType] = {name: _parse(f"{columns}, {LINEAGE}") for name, columns in _COLUMNS.items()}

#: tables with names or addresses of people and firms never leave the premises
PUBLISHABLE = frozenset({"mark_features_v1", "event_series_v1", "evaluation_labels_v1", "detector_v1"})


def assert_publishable(table: str) -> None:
    """Only tables on the allow-list may be published."""
    if table not in PUBLISHABLE:
        raise PermissionError(f"{table} is not on the list of publishable tables")
