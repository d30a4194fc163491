"""The number of tasks of the large joins and groupings follows the rows, not the session's shuffle partitions."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict

import pytest

from churnlens import catalog, catalog_stored
from churnlens.sources import tables
from churnlens.sources.tables import SCHEMAS, repo_contributors, user_profiles

N_LINES, EACH = 2000, 100
_DAY = dt.datetime(2024, 1, 2)


@pytest.fixture()
def rows(spark, scratch, monkeypatch):
    """Small tables with null and repeated keys in a folder, with tasks of 100 rows in a session of 2 shuffle partitions."""
    pick = random.Random(7)

    def some(n):
        return None if pick.random() < 0.03 else pick.randrange(n)
    data = {
        "customer": [(None if k == 999 else k % 990, f"c{k}", k % 25, k - 300.0, pick.choice(["BUILDING", "AUTOMOBILE", "MACHINERY"])) for k in range(1000)],
        "orders": [(some(400), some(60), pick.choice("FOP"), 1.0, dt.datetime(1997, 1, 1) + dt.timedelta(days=pick.randrange(290)), "1") for _ in range(500)],
        "lineitem": [(some(400), some(80), some(10), 1, 1.0, 1.0, 0.0, 0.0, "A", "F", _DAY) for _ in range(N_LINES)],
        "part": [(some(80), "p", f"Brand#{pick.randrange(5)}", "t", 1, 1.0) for _ in range(120)],
        "events": [(i, _DAY + dt.timedelta(hours=pick.randrange(360)), some(60), pick.choice(["click", "view", "purchase", "signup", "error"]), 1.0, "{}") for i in range(600)],
    }
    for name, values in data.items():
        spark.createDataFrame(values, SCHEMAS[name]).coalesce(1).write.parquet(f"{scratch}/{name}.parquet")
    monkeypatch.setattr(tables, "TASK_ROWS", EACH)
    keys = {"spark.sql.shuffle.partitions": "2", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    held = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield scratch, data
    for k, v in held.items():
        spark.conf.set(k, v)


def dealt(df) -> dict:
    """Least number of tasks that rows are dealt to by each first key."""
    out = {}
    for key, n in re.findall(r"hashpartitioning\((\w+)#\d+L?(?:, \w+#\d+L?)*, (\d+)\)", df._jdf.queryExecution().executedPlan().toString()):
        out[key] = min(int(n), out.get(key, int(n)))
    return out


def _lines_of_customers(data):
    orders = defaultdict(list)
    for key, cust, *_ in data["orders"]:
        if key is not None:
            orders[key].append(cust)
    return [(cust, line) for line in data["lineitem"] if line[0] is not None for cust in orders[line[0]]]


def test_profiles_count_exactly_in_small_tasks(spark, rows):
    folder, data = rows
    df = user_profiles(spark, folder)
    plan = dealt(df)
    assert plan["l_orderkey"] >= N_LINES // EACH and plan["o_orderkey"] >= N_LINES // EACH
    pairs = re.findall(r"hashpartitioning\(login#\d+L, is_part#\d+, thing#\d+L, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())
    assert pairs and min(map(int, pairs)) >= 2 * N_LINES // EACH
    lines = defaultdict(list)
    for cust, line in _lines_of_customers(data):
        lines[cust].append(line)
    n_orders = Counter(o[1] for o in data["orders"])
    want = Counter()
    for key, name, *_ in data["customer"]:
        held = lines[key] if key is not None else []
        want[key, name, n_orders[key] if key is not None else 0, len(held), len({x[1] for x in held} - {None}), len({x[2] for x in held} - {None})] += 1
    cols = ("login", "bio", "followers_count", "following_count", "public_repos_count", "public_gists_count")
    assert Counter(tuple(r) for r in df.select(*cols).collect()) == want


def test_colocated_buckets_follow_the_users(spark, rows):
    folder, data = rows
    merged = catalog_stored.m24_colocated_merge(spark, folder)
    assert merged.rdd.getNumPartitions() == len(data["customer"]) // EACH  # 8 before, however many users
    assert Counter(merged.collect()) == Counter(catalog.m24_churn_table(spark, folder).collect())


def test_contributors_count_exactly_in_small_tasks(spark, rows):
    folder, data = rows
    df = repo_contributors(spark, folder)
    plan = dealt(df)
    assert all(plan[k] >= N_LINES // EACH for k in ("l_orderkey", "o_orderkey", "l_partkey", "p_partkey", "repo"))
    brands = defaultdict(list)
    for key, _, brand, *_ in data["part"]:
        if key is not None:
            brands[key].append(brand)
    want = Counter((brand, cust) for cust, line in _lines_of_customers(data) if line[1] is not None for brand in brands[line[1]])
    assert {(r.repo, r.login): r.repo_contributions_count for r in df.collect()} == want
    filled = catalog.p11_p12_p15_serving_fill(spark, folder)
    sides = re.findall(r"hashpartitioning\((?:login|actor)#\d+L, (\d+)\), REPARTITION_BY_NUM", filled._jdf.queryExecution().executedPlan().toString())
    assert len(sides) == 2 and min(map(int, sides)) >= len(want) // EACH
    first = {r.login: r.frequency for r in filled.collect()}
    events = Counter(e[2] for e in data["events"] if e[1] < dt.datetime(2024, 1, 16))
    assert first == {cust: events[cust] for _, cust in want if cust is not None} | ({None: 0} if None in first else {})


def test_lifetime_summary_merges_one_analysis_at_a_time(spark, rows):
    folder, data = rows
    summary = catalog._lifetime_summary(spark, folder)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "orders.parquet" not in plan and "user-profiles" not in plan
    assert plan.count("SortMergeJoin") == 1
    from churnlens.operators.merge import churn_table
    from churnlens.plans.lifetime import lifetime_summary
    from churnlens.sources.logs import orders_log
    users = user_profiles(spark, folder).where("login < 10")  # logins without copies
    whole = lifetime_summary(churn_table(users, orders_log(spark, folder), catalog.ORDERS_SPEC), churn_table(users, catalog._ev(spark, folder), catalog.SPEC),
                             catalog.LIFETIME_END, catalog.LIFETIME_FILL)
    want = Counter(whole.where("login IS NOT NULL").collect())
    got = Counter(r for r in summary.collect() if r.login is not None and r.login < 10)
    copied = {c[0] for c, n in Counter((x[0],) for x in data["customer"]).items() if n > 1}
    assert {r for r in got if r.login not in copied} == {r for r in want if r.login not in copied} and want
