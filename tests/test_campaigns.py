from datetime import datetime

import pytest

from orderflow.operators import campaigns as ca

CAMPAIGN = "campaign_id bigint, campaign_name string, region_id int, end_date timestamp_ntz, state string"
ATTR = "mkt_campaign_id bigint, attr_nbr string, attr_value_id bigint, attr_value string"
REGION = "region_id int, region_name string, region_id_old int"
NAME = ca.CATALOG_ATTRIBUTE


@pytest.fixture
def active(make):
    later = datetime(2030, 1, 1)
    campaigns = make(CAMPAIGN, (1, "a", 10, later, "10A"), (2, "b", 11, later, "10A"),
                     (3, "c", 12, later, "10A"), (4, "d", 10, later, "10X"),
                     (5, "e", 10, datetime(2024, 5, 3), "10A"),
                     (6, "f", 10, datetime(2024, 5, 3, 0, 0, 1), "10A"))
    attrs = make(ATTR, *[(i, NAME, 7, "main") for i in range(1, 7)], (1, "OTHER", 7, "x"),
                 (2, NAME, 8, "other main"))
    regions = make(REGION, (10, "all", 999), (11, "none", None), (12, "one", 915))
    return lambda catalog=7: ca.active_campaigns(campaigns, attrs, regions, catalog,
                                                 "2024-05-10 12:00:00")


def test_active_campaigns(active, rows):
    # campaign 5 ended exactly seven days before midnight, campaign 6 a second later
    assert rows(active(), "sub_campaign_id") == [(1,), (2,), (3,), (6,)]
    assert len(rows(active(None))) == 5


@pytest.fixture
def channel_rel(make):
    return make("campaign_id bigint, channel_id int", (1, 3), (1, 4), (2, 3), (2, 6), (3, 6),
                (6, 6), (3, 3))


def test_receive_areas(active, channel_rel, make, rows):
    pairs = ca.campaigns_by_area(active(), channel_rel, mode="receive",
                                 channels=make("channel_id int", (3,), (4,)), areas="290,910")
    # 999 fans out once in spite of two channels; NULL is area 888; 915 is itself
    assert rows(pairs, "sub_campaign_id", "latn_id") == [(1, 290), (1, 910), (2, 888), (3, 915)]


def test_outcall_areas(active, channel_rel, rows):
    pairs = ca.campaigns_by_area(active(), channel_rel, mode="outcall", areas=[290, 910])
    assert rows(pairs, "sub_campaign_id", "latn_id") == [(2, 290), (2, 910), (3, 915), (6, 999)]


def test_areas_keep_duplicate_attachments(active, channel_rel, make, rows):
    twice = active().unionAll(active())
    pairs = ca.campaigns_by_area(twice, channel_rel, mode="outcall", areas="290")
    assert rows(pairs, "sub_campaign_id", "latn_id").count((3, 915)) == 2


def test_unknown_mode(active, channel_rel):
    with pytest.raises(ValueError):
        ca.campaigns_by_area(active(), channel_rel, mode="mail")


def test_explode_list(make, rows):
    df = make("id int, t string", (1, "290,,x, 910"), (2, None), (3, ""))
    assert rows(ca.explode_list(df, "t", "a"), "id", "a") == [(1, 290), (1, 910)]


RULE = "suc_rule_id int, rule_name string, report_column string, state int, sql_text_order string"
REL = "suc_rule_id int, campaign_id bigint, rel_type int, rel_id bigint, seq int"
PAIR = "main_campaign_id bigint, sub_campaign_id bigint"


def test_rules_are_the_intersection_in_main_order(make, rows):
    rules = make(RULE, *[(i, f"r{i}", f"col_{i}", 20 if i == 4 else 10, "x") for i in range(1, 6)])
    rel = make(REL, (1, 7, 1, 0, 9), (2, 7, 1, 0, 5), (3, 7, 1, 0, 5), (4, 7, 1, 0, 1),
               (1, 70, 2, 101, 0), (2, 70, 2, 102, 1), (3, 70, 2, 103, 0), (4, 70, 2, 104, 0),
               (5, 70, 2, 105, 0), (1, 71, 2, 111, 0))
    ranked = ca.success_rules(rules, rel, make(PAIR, (7, 70), (7, 70), (7, 71), (8, 70)))
    assert rows(ranked, "sub_campaign_id", "seq_no", "suc_rule_id", "rel_id") == [
        (70, 1, 2, 102), (70, 2, 3, 103), (70, 3, 1, 101), (71, 1, 1, 111)]


def test_more_than_twenty_rules_are_all_ranked(make, rows):
    rules = make(RULE, *[(i, "r", "col_1", 10, "x") for i in range(25)])
    rel = make(REL, *[(i, 7, 1, 0, i) for i in range(25)], *[(i, 70, 2, i, 0) for i in range(25)])
    ranked = ca.success_rules(rules, rel, make(PAIR, (7, 70)))
    assert rows(ranked, "seq_no") == [(i,) for i in range(1, 26)]
