"""Three cycles over a small landing zone."""

import json

import pytest
from helpers import rows

from tidemark import names as n
from tidemark.operators.quality import Rule
from tidemark.plans.cycle import run_cycle
from tidemark.plans.insurance import claim_detail, claim_financial
from tidemark.plans.jobspec import JobSpec
from tidemark.plans.warehouse import Warehouse
from tidemark.sources import deliveries

CDC = f"{n.OPERATION} int, {n.PAYLOAD_TS} bigint, {n.SEQUENCE} string"
POLICY = f"id string, publicid string, policynumber string, premium double, retired int, {CDC}"
CLAIM = f"id string, publicid string, claimnumber string, policyid string, state string, retired int, {CDC}"
TXN = f"id string, publicid string, claimid string, amount double, costtype string, costcategory string, retired int, {CDC}"



def job_text(driving, joined, on, columns):
    """A job's SQL from its mapping: output name to (side, column)."""
    shown = ", ".join(f"{side}.{column} AS {name}" for name, (side, column) in columns.items())
    audit = ", ".join(f"d.{c}" for c in (n.SOFT_DELETE, n.FINGERPRINT, n.DELIVERY, n.AUDIT_TS))
    where = "@catalog.@src_schema."
    return (
        f"SELECT {shown}, d.{n.RUN} AS cyc_run_sk, {audit} FROM {where}{driving} d "
        f"LEFT JOIN {where}{joined} j ON d.{on} = j.id WHERE d.{n.SOFT_DELETE} = 'N'"
    )


DETAIL = JobSpec(
    1, "claim_detail", ("id",), "claim_detail_sk", "cc_claim", ("id",),
    job_text("cc_claim", "cc_policy", "policyid", {
        "id": ("d", "id"), "claim_publicid": ("d", "publicid"), "claimnumber": ("d", "claimnumber"),
        "policyid": ("d", "policyid"), "lossstate": ("d", "state"),
        "policynumber": ("j", "policynumber"), "premium": ("j", "premium"),
    }),
    lookups=(("cc_policy", "policyid", "id"),),
)
FINANCIAL = JobSpec(
    2, "claim_financial", ("id",), "claim_financial_sk", "cc_transaction", ("id",),
    job_text("cc_transaction", "cc_claim", "claimid", {
        "id": ("d", "id"), "transaction_publicid": ("d", "publicid"), "claimid": ("d", "claimid"),
        "amount": ("d", "amount"), "costtype": ("d", "costtype"),
        "costcategory": ("d", "costcategory"), "claimnumber": ("j", "claimnumber"),
    }),
    lookups=(("cc_claim", "claimid", "id"),),
)


class Landing:
    def __init__(self, spark, root):
        self.spark, self.root, self.entries = spark, root, {}

    def deliver(self, table, fingerprint, ts, data, schema):
        full = [(*e, f"{e[-1]:016x}") for e in data]
        deliveries.write_delivery(self.spark.createDataFrame(full, schema), self.root, table, fingerprint, str(ts))
        entry = self.entries.setdefault(table.upper(), {"dataFilespath": f"CC/{table.upper()}", "schemaHistory": {}})
        entry["lastSuccessfulWriteTimestamp"] = str(ts)
        entry["schemaHistory"].setdefault(fingerprint, str(ts))
        entry["totalProcessedRecordsCount"] = "1"
        with open(f"{self.root}/manifest.json", "w") as out:
            json.dump(self.entries, out, indent=1)


def metrics(result):
    return {r["table_name"]: r for df in (*result.replicas, *result.refined) for r in df.collect()}


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    (root / "landing").mkdir()
    return Landing(spark, str(root / "landing")), Warehouse(spark, str(root / "wh"))


def cycle(world, run, previous, rules=None):
    landing, wh = world
    return run_cycle(
        wh, landing.root, "CC", [DETAIL, FINANCIAL], 1, run, f"2024-01-0{run} 00:00:00", previous, rules,
        refined_balance=("claim_detail", "claim_financial"), first_val_run=10,
    )


def test_three_cycles(world):
    landing, wh = world
    landing.deliver("cc_policy", "pf", 1000, [("p1", "pp1", "N1", 10.0, 0, 0, 1), ("p2", "pp2", "N2", 20.0, 0, 0, 1)], POLICY)
    landing.deliver(
        "cc_claim", "cf", 1000,
        [("c1", "pc1", "CL1", "p1", "Open", 0, 0, 1), ("c1", "pc1", "CL1", "p1", "Draft", 0, 0, 0),
         ("c2", "pc2", "CL2", None, "Open", 0, 0, 1), ("c3", "pc3", "CL3", "p2", "Open", 0, 0, 1)], CLAIM,
    )
    landing.deliver(
        "cc_transaction", "tf", 1000,
        [("t1", "pt1", "c1", 10.25, "claimcost", "LossPayment", 0, 0, 1),
         ("t2", "pt2", "c3", 5.5, "aoexpense", "ExpenseReserve", 0, 0, 1)], TXN,
    )
    first = cycle(world, 1, 0)
    assert first.loaded == ["cc_claim", "cc_policy", "cc_transaction"]
    assert {k: r["status"] for k, r in metrics(first).items()} == dict.fromkeys(
        ["cc_claim", "cc_policy", "cc_transaction", "claim_detail", "claim_financial"], "S"
    )
    assert all(r["status"] == "PASSED" for df in first.balances for r in df.collect())
    assert rows(wh.replica("cc_claim").read(), "id", "state") == [("c1", "Open"), ("c2", "Open"), ("c3", "Open")]
    assert rows(wh.refined("claim_detail").read(), "id", "policynumber", n.ACTIVE) == [
        ("c1", "N1", "Y"), ("c2", None, "Y"), ("c3", "N2", "Y"),
    ]

    # nothing new: nothing is loaded and nothing changes
    idle = cycle(world, 2, 1)
    assert idle.loaded == []
    assert {r["rows_inserted"] for r in metrics(idle).values()} == {0}
    assert wh.refined("claim_detail").read().count() == 3

    # an update, a delete, a new claim and a new schema version of the claim table
    landing.deliver(
        "cc_claim", "cg", 3000,
        [("c1", "pc1", "CL1", "p1", "Closed", "x", 0, 2, 5), ("c3", "pc3", "CL3", "p2", "Open", "x", 0, 1, 5),
         ("c4", "pc4", "CL4", "p2", "Open", "x", 0, 0, 5)],
        CLAIM.replace("state string", "state string, catastropheid string"),
    )
    landing.deliver(
        "cc_transaction", "tf", 3000,
        [("t2", "pt2", "c3", 5.5, "aoexpense", "ExpenseReserve", 0, 1, 5),
         ("t3", "pt3", "c4", 7.0, "claimcost", "LossReserve", 0, 0, 5)], TXN,
    )
    rule = Rule(1, "SELECT publicid FROM cc_claim WHERE state = 'Closed'", "cc_claim", "publicid", "no closed claims")
    joined = Rule(2, "SELECT c.publicid FROM cc_claim c JOIN cc_transaction t ON t.claimid = c.id "
                  "WHERE t.amount > 1000", "cc_claim", "publicid", "no dear claims")
    third = cycle(world, 3, 2, {"cc_claim": [rule, joined]})
    assert third.loaded == ["cc_claim", "cc_transaction"]
    got = metrics(third)
    assert {k: r["status"] for k, r in got.items()} == dict.fromkeys(
        ["cc_claim", "cc_transaction", "claim_detail", "claim_financial"], "S"
    )
    assert (got["cc_claim"]["rows_read"], got["cc_claim"]["rows_deleted"]) == (3, 1)
    assert (got["claim_detail"]["rows_inserted"], got["claim_detail"]["rows_updated"]) == (2, 1)
    assert rows(wh.replica("cc_claim").read(), "id", "state", "catastropheid", n.SOFT_DELETE, n.VALIDATION) == [
        ("c1", "Closed", "x", "N", "F"), ("c2", "Open", None, "N", None),
        ("c3", "Open", None, "Y", None), ("c4", "Open", "x", "N", None),
    ]
    detail = wh.refined("claim_detail").read()
    assert rows(detail, "id", "lossstate", n.ACTIVE, n.INSERT_RUN, n.LAST_RUN) == [
        ("c1", "Closed", "Y", "3", "3"), ("c1", "Open", "N", "1", "3"), ("c2", "Open", "Y", "1", "1"),
        ("c3", "Open", "N", "1", "3"), ("c4", "Open", "Y", "3", "3"),
    ]
    assert sorted(r["claim_detail_sk"] for r in detail.collect()) == [1, 2, 3, 4, 5]
    assert all(r["status"] == "PASSED" for df in third.balances for r in df.collect())
    assert rows(third.validations[0], "val_run_sk", "val_status", "total_count", "failed_count") == [
        (10, "F", 3, 1), (11, "S", 3, 0),
    ]
    assert rows(wh.control("validation_error_log").read(), "gw_error_values") == [("pc1",)]
    assert wh.control("balance_metrics").read().count() == 30
    assert rows(wh.control_rows("file_loads"), "table_name", "gw_timestamp", "is_loaded") == [
        ("cc_claim", "1000", True), ("cc_claim", "3000", True), ("cc_policy", "1000", True),
        ("cc_transaction", "1000", True), ("cc_transaction", "3000", True),
    ]
    assert sorted(r["file_load_id"] for r in wh.control_rows("file_loads").collect()) == [1, 2, 3, 4, 5]
    assert wh.control_rows("manifest").count() == 3
    assert wh.control_rows("manifest_archive").count() == 6
    assert wh.control("file_loads_backup").read().count() == 5


def test_projections_equal_the_job_queries(spark, world):
    _, wh = world
    claims, policies = wh.replica("cc_claim").read(), wh.replica("cc_policy").read()
    transactions = wh.replica("cc_transaction").read()
    wh.publish_replicas(["cc_claim", "cc_policy", "cc_transaction"])
    for built, spec in (
        (claim_detail(claims, policies), DETAIL),
        (claim_financial(transactions, claims), FINANCIAL),
    ):
        wanted = spec.rows(spark)
        assert rows(built.select(*wanted.columns)) == rows(wanted)


def test_a_failed_table_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    landing, wh = Landing(spark, str(tmp_path / "landing")), Warehouse(spark, str(tmp_path / "wh"))

    def run(number):
        return run_cycle(wh, landing.root, "CC", [], 1, number, f"2024-01-0{number} 00:00:00", balance=False)

    plain = f"id string, v string, {CDC}"
    for table in ("cc_a", "cc_b"):
        landing.deliver(table, "f", 1000, [("a", "x", 0, 1)], plain)
    assert {k: r["status"] for k, r in metrics(run(1)).items()} == {"cc_a": "S", "cc_b": "S"}
    landing.deliver("cc_a", "g", 2000, [("b", 1, 0, 2)], plain.replace("v string", "v int"))
    landing.deliver("cc_b", "f", 2000, [("b", "y", 0, 2)], plain)
    got = metrics(run(2))
    assert (got["cc_a"]["status"], got["cc_b"]["status"]) == ("F", "S")
    assert "v: string to int" in got["cc_a"]["error_msg"]
    again = metrics(run(3))  # nothing new has landed, but one delivery still waits
    assert set(again) == {"cc_a"}
    wh.control("file_loads_archive").append(wh.control_rows("file_loads"))
    wh.control("file_loads").write(wh.control_rows("file_loads").limit(0))
    assert run(4).loaded == [] and wh.control_rows("file_loads").count() == 0


def test_arguments_of_a_cycle(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no job writes"):
        run_cycle(wh, "", "CC", [DETAIL], 1, 1, "", refined_balance=("claim_detail", "other"))
    with pytest.raises(ValueError, match="first_val_run"):
        run_cycle(wh, "", "CC", [], 1, 1, "", rules={"cc_a": []})
