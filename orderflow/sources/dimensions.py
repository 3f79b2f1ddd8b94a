"""What a dimension refresh copies: one explicit column list per table."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Snapshot:
    """Columns to copy (empty = all), whether to drop duplicate rows, whether to stamp."""

    columns: tuple[str, ...] = ()
    distinct: bool = False
    stamped: bool = False


def _columns(text: str) -> tuple[str, ...]:
    return tuple(text.split())


# The column lists of the refreshed tables, in table order. The user table's
# password column is left out on purpose.
SNAPSHOTS: dict[str, Snapshot] = {
    "tb_pty_grid_tree": Snapshot(_columns("""
        tree_id tree_name p_tree_id tree_level orders net_code latn_id latn_name channel_type
        admin_flag state create_date area_id y_area_id tree_remark channel_name
        channel_secend_type channel_secend_type_name channel_third_type channel_third_type_name
        channel_level channel_level_name channel_secend_level channel_secend_level_name
        admin_name admin_tel admin_addr channel_type_name channel_id channel_fenlei_id
        channel_fenlei_name channel_code state_date channel_manage_pro channel_manage_pro_name
        business_exc role_type obu_type_1 obu_type_2 obu_type_3 tree_id_path contract_model
        peopletype custmoer_qun bus_user_rate contract_model_five contract_code
        activity_propertyl_five area_attribute_five block_type_1 block_type_2 block_type_3
        contract_type""")),
    "channel": Snapshot(_columns("""
        channel_id channel_name channel_level_cd channel_type_cd channel_subtype_cd status_cd
        parent_chn_id channel_nbr common_region_id prov_code channel_spec_id capacity start_dt
        end_dt open_time close_time description version cc_code_mkt cc_code_part cc_code_oper
        oper_flag status_date cc_province cc_city cc_county cc_town cc_addr is_iphone latn_id
        zone_id cc_number_oper jt_uni_number lord_number if_jt org_id channel_class ecs_code
        cbs_code channel_third_type action channel_create_time loc_x loc_y gps_loc_x gps_loc_y
        chn_type_cd five_grid_id common_region_town_id approve_number channel_photos
        ext_channel_id""")),
    "organization": Snapshot(_columns("""
        org_id common_region_id org_type org_name latn_id status_cd org_code org_jt_code
        update_date jt_uni_number channel_third_type""")),
    "chn_sale_outlets_grid_rel": Snapshot(_columns("""
        grid_id chn_sale_outlets_id modify_date status""")),
    "t_grid_org_code_rel": Snapshot(stamped=True),
    "staff": Snapshot(_columns("""
        staff_id staff_code org_id staff_name staff_desc status_cd status_date create_date
        party_id empee_addr_desc empee_email_addr empee_mob_no empee_tele_no empee_phs_no
        staff_type cert_nubr login_num latn_id pwd_crt_date title ip_address mac empee_level qq
        msn hr_personid style pty_latn_id gprovice url_mapping site_id eff_date exp_date
        user_type staff_sex staff_birthday staff_pinyin pty_id""")),
    "system_user": Snapshot(_columns("""
        system_user_id staff_id status_cd status_date create_date system_user_code eff_date
        exp_date login_num password_time mobile_telephone mark last_login_time
        is_test_user""")),
    "mkt_campaign_all": Snapshot(_columns("""
        mkt_campaign_id tigger_type mkt_campaign_name plan_begin_time plan_end_time begin_time
        end_time mkt_campaign_type mkt_activity_nbr mkt_activity_target mkt_campaign_desc
        exec_type exec_invl exec_num status_cd status_date create_staff create_date update_staff
        update_date remark lan_id mkt_campaign_category mkt_campaign_full_name
        mkt_main_campaign_id assemble_templet_id life_cycle theme_id assess_template_id
        evaluate_days cycle_type cycle_expression cycle_active_days campaign_templet_id
        is_template proc_def_id is_test area_id is_exist_wave cycle_tigger_immediate""")),
    "block_contractor_rela": Snapshot(_columns("""
        latn_id latn_name area_id area_name obu_id obu_name block_id block_name staff_id
        staff_name staff_code"""), distinct=True),
}
