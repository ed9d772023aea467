"""The affected rows of a left join, and refine jobs over them against jobs over everything."""

import random

import pytest
from helpers import plan, rows

from tidemark import names as n
from tidemark.operators import delta
from tidemark.operators.delta import Reference, affected_rows, referred_rows
from tidemark.plans.jobspec import JobSpec
from tidemark.plans.refine import refine, refine_job
from tidemark.plans.warehouse import Warehouse
from tidemark.session import Staging

TEXT = (
    "SELECT d.id, d.a, d.b, x.v AS xv, y.v AS yv, d.GW_TIMESTAMP FROM @catalog.@src_schema.driving d "
    "LEFT JOIN @catalog.@src_schema.xs x ON d.a = x.id LEFT JOIN @catalog.@src_schema.ys y ON d.b = y.id "
    "WHERE d.Soft_Delete = 'N'"
)
SPEC = JobSpec(1, "detail", ("id",), "sk", "driving", ("id",), TEXT, lookups=(("xs", "a", "id"), ("ys", "b", "id")))
SHOWN = ("id", "a", "b", "xv", "yv", "sk", n.ACTIVE, n.EFFECTIVE, n.EXPIRY, n.LAST_RUN, n.INSERT_RUN)


class World:
    """Three tables that change from run to run; a change stamps the row with the run."""

    def __init__(self, seed):
        self.rng = random.Random(seed)
        self.driving, self.xs, self.ys = {}, {}, {}

    def step(self, run):
        pick = self.rng.choice
        for side in (self.xs, self.ys):
            for k in range(12):
                if pick([True, False, False]):
                    side[k] = (k, pick("pqr"), pick("NNY"), run)
        for k in range(40):
            if pick([True, False, False, False]):
                fk = [None, *range(14)]  # some keys refer to nothing
                self.driving[k] = (k, pick(fk), pick(fk), pick("NNNY"), run, "1000")

    def tables(self, spark):
        side = f"id int, v string, {n.SOFT_DELETE} string, {n.RUN} int"
        yield "xs", spark.createDataFrame(list(self.xs.values()), side)
        yield "ys", spark.createDataFrame(list(self.ys.values()), side)
        yield "driving", spark.createDataFrame(
            list(self.driving.values()), f"id int, a int, b int, {n.SOFT_DELETE} string, {n.RUN} int, {n.DELIVERY} string"
        )


@pytest.mark.parametrize("seed", [1, 2])
def test_delta_and_full_jobs_agree(spark, tmp_path, seed):
    part, full, world = Warehouse(spark, f"{tmp_path}/d"), Warehouse(spark, f"{tmp_path}/f"), World(seed)
    for run in (1, 2, 3, 4):
        world.step(run)
        for wh in (part, full):
            for name, table in world.tables(spark):
                wh.replica(name).write(table)
            wh.publish_replicas(["xs", "ys", "driving"])
            ts = f"2024-01-0{run} 00:00:00"
            if wh is part:
                got = refine_job(wh, SPEC, run, ts, run - 1).first()
            else:
                want = refine(wh, SPEC, SPEC.rows(spark), run, ts, run - 1).first()
        assert rows(part.refined("detail").read(), *SHOWN) == rows(full.refined("detail").read(), *SHOWN)
        assert got == want


@pytest.mark.parametrize("small", [True, False])
def test_affected_rows(spark, monkeypatch, small):
    monkeypatch.setattr(delta, "fits_broadcast", lambda df: small)
    driving = spark.createDataFrame(
        [(1, 10, 1), (2, 11, 1), (3, None, 1), (4, None, 2), (5, 12, 2), (6, 11, None), (7, 10, 1), (7, 10, 1)],
        f"id int, fk int, {n.RUN} int",
    )
    lookup = spark.createDataFrame([(10, 2), (11, 1), (12, 2), (None, 2)], f"id int, {n.RUN} int")
    with Staging(spark) as staging:
        got = affected_rows(driving, [Reference(lookup, "fk")], 1, staging)
        assert rows(got) == [(1, 10, 1), (4, None, 2), (5, 12, 2), (6, 11, None), (7, 10, 1), (7, 10, 1)]
        assert not small or "BroadcastHashJoin" in plan(got)
        needed = referred_rows(got, Reference(lookup, "fk"), staging)
        assert rows(needed) == [(10, 2), (11, 1), (12, 2)] if small else rows(lookup)


def test_changes_reach_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "id AS fk", f"CAST(id AS INT) AS {n.RUN}").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    text = plan(delta.changed_keys(table, "id", 5))
    assert "PushedFilters" in text and f"ReadSchema: struct<id:bigint,{n.RUN}:int>" in text


def test_jobs_that_need_the_whole_source(spark, tmp_path):
    assert JobSpec(1, "t", ("id",), "sk", "d", ("id",), "SELECT a.id FROM d a JOIN D b ON a.id = b.id").rows_of(spark.range(1)) is None
    wh = Warehouse(spark, str(tmp_path))
    from tidemark.plans.refine import delta_source

    with Staging(spark) as staging:
        assert delta_source(wh, SPEC, 1, staging) is None  # nothing was loaded yet


def test_lookups_come_from_the_job_parameters(spark):
    jobs = spark.createDataFrame([(5, "t")], "job_sk int, tgt_file_tbl string")
    values = [("src_keys", "id"), ("SurrogateKey", "sk"), ("Driving_Table", "d"), ("Driving_Table_PK", "id"),
              ("Lookup_Tables", "xs:a:id, ys:b:id"), ("tfm_query", "SELECT 1")]
    params = spark.createDataFrame([(i, 5, *v) for i, v in enumerate(values)], "parm_sk int, job_sk int, parm_nm string, parm_val string")
    assert JobSpec.load(jobs, params, 5).lookups == (("xs", "a", "id"), ("ys", "b", "id"))
