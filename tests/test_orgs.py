from orderflow.operators import orgs as og

GRID = "org_jt_code bigint, org_id bigint, fir_grid_id int, sec_grid_id int, thi_grid_id bigint"
ORG = ("bss_org_id bigint, bss_org_name string, bss_org_type_id int, up_bss_org_id bigint, "
       "area_id int, state string")


def test_best_grid(make, rows):
    grid = make(GRID,
                (1, 11, 1, 2, 5), (1, 12, 3, 4, 9),          # larger grid wins
                (2, 21, 1, 2, 99), (2, 22, 3, 4, None),      # NULL grid wins
                (3, 31, 1, 2, -7),                           # below the sentinel
                (4, 41, 1, 2, 6), (4, 42, 3, 4, 6))          # tie
    held = make("id int, dept_id bigint", (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, None))
    assert rows(og.grid_lookup(held, grid), "id", "fir_grid_id", "sec_grid_id", "thi_grid_id",
                "org_id") == [
        (1, 3, 4, 9, 12), (2, 3, 4, None, 22), (3, -2, -2, -2, -2), (4, 3, 4, 6, 42),
        (5, -2, -2, -2, -2), (6, -1, -1, -1, None)]


def tree(make):
    return make(ORG, (1, "prov", 1, None, None, "10A"), (10, "city", 2, 1, 5, "10A"),
                (100, "team", 3, 10, 5, "10A"), (101, "closed team", 3, 10, 5, "10X"),
                (1000, "class", 4, 100, 5, "10A"), (1001, "orphan", 4, 101, 5, "10A"),
                (11, "closed city", 2, 1, 6, "10X"))


def test_city_and_class(make, rows):
    assert rows(og.city_with_province(tree(make)), "region_id", "city_dept_id",
                "prov_dept_name") == [(5, 10, "prov")]
    assert (1000, "class", 100, "team") in rows(og.class_with_team(tree(make)))
    assert all(r[0] != 1001 for r in rows(og.class_with_team(tree(make))))


def test_callers(make, rows):
    jobs = make("user_id bigint, bss_org_id bigint, role_id int", (7, 1000, 10004),
                (7, 1000, 10070), (8, 1000, 1), (9, 1001, 10071))
    users = make("user_id bigint, user_name string, state string", (7, "x", "10A"),
                 (9, "y", "10X"))
    # two roles give one row; closed teams and users still count
    assert rows(og.org_callers(tree(make), jobs, users, "2024-01-02 00:00:00"), "caller_id",
                "class_dept_id", "team_dept_id", "city_dept_id", "prov_dept_id") == [
        (7, 1000, 100, 10, 1), (9, 1001, 101, 10, 1)]


def test_resolution(make, rows):
    changes = make("list_id bigint, status_cd int, dept_id bigint, curr_user_id bigint, "
                   "order_result bigint, org_type_id int",
                   (1, 2100, 1000, 7, None, 4),    # held: class, team, caller
                   (2, 2100, 1000, 99, None, 4),   # unknown user
                   (3, 2100, 1001, 7, None, 4),    # class without active team
                   (4, 2100, 100, None, 5, 3),     # team
                   (5, 2100, 101, None, 5, 3),     # closed team
                   (6, 2100, 1000, None, None, 4),  # class without a result is looked up too
                   (7, 2100, 10, None, 5, 2),      # other type
                   (8, 2100, None, None, 5, 0),    # nobody
                   (9, 2100, 1000, 55, None, 4))   # two active users of that id
    users = make("user_id bigint, user_name string, state string", (7, "x", "10A"),
                 (55, "a", "10A"), (55, "b", "10A"))
    out = og.resolve_outcall_org(changes, tree(make), users)
    assert rows(out, "list_id", "action", "problem", "team_dept_id", "class_dept_id",
                "caller_name") == [
        (1, "user", None, 100, 1000, "x"), (2, "user", "missing", 100, 1000, None),
        (3, "user", "missing", None, 1001, "x"), (4, "team", None, 100, None, None),
        (5, "team", "missing", 101, None, None), (6, "class", None, 100, 1000, None),
        (7, "none", None, None, None, None), (8, "none", None, None, None, None),
        (9, "user", "ambiguous", 100, 1000, "a")]
