"""Refined jobs described by (job, name, value) parameter rows."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as n

# --- fixed values: parameter names ----------------------------------------------
PARAMETERS = (
    "src_keys",
    "SurrogateKey",
    "partition",
    "scdexclusions",
    "Driving_Table",
    "Driving_Table_PK",
)
#: Own parameter: tables the driving rows refer to, as table:foreign_key:key, comma-separated.
LOOKUPS = "Lookup_Tables"


def job_parameters(jobs: DataFrame, parameters: DataFrame) -> DataFrame:
    """One row per job: its target and its parameters as columns; query parts in order.

    Parameter rows are few per job, so the text of one job always fits one task.
    """
    mine = jobs.select("job_sk", "tgt_file_tbl").join(parameters, "job_sk")
    is_query = F.col("parm_nm").contains("tfm_query")
    part = F.when(is_query, F.struct("parm_sk", F.coalesce("parm_val", F.lit("")).alias("v")))
    parts = F.array_sort(F.collect_list(part))
    return mine.groupBy("job_sk", "tgt_file_tbl").agg(
        *[
            F.first(F.when(F.col("parm_nm") == p, F.col("parm_val")), ignorenulls=True).alias(p.lower())
            for p in (*PARAMETERS, LOOKUPS)
        ],
        F.concat_ws(" ", F.transform(parts, lambda x: x["v"])).alias("tfm_query"),
    )


def render_sql(query: str, catalog: str | None = None, schema: str | None = None) -> str:
    """Fill ``@catalog`` and ``@src_schema``; without them tables are session views."""
    if catalog is None:
        query = query.replace("@catalog.", "")
    else:
        query = query.replace("@catalog", catalog)
    if schema is None:
        return query.replace("@src_schema.", "")
    return query.replace("@src_schema", schema)


def _list(text: str | None) -> tuple[str, ...]:
    return tuple(part.strip() for part in (text or "").split(",") if part.strip())


@dataclass(frozen=True)
class JobSpec:
    job_sk: int
    target: str
    keys: tuple[str, ...]
    surrogate: str
    driving_table: str
    driving_keys: tuple[str, ...]
    query: str
    exclusions: tuple[str, ...] = n.DEFAULT_EXCLUSIONS
    order: tuple[str, ...] = (n.DELIVERY,)
    #: (table, foreign key in the driving table, key) of each table that the query left-joins to the
    #: driving table. With them a run needs the rows affected by changes only.
    lookups: tuple[tuple[str, str, str], ...] = ()

    @classmethod
    def load(cls, jobs: DataFrame, parameters: DataFrame, job_sk: int) -> JobSpec:
        """Read one job. Only this job's single parameter row comes to the driver."""
        chosen = jobs.filter(F.col("job_sk") == job_sk)
        row = job_parameters(chosen, parameters.filter(F.col("job_sk") == job_sk)).first()
        if row is None:
            raise LookupError(f"job {job_sk} has no parameters")
        return cls(
            job_sk=job_sk,
            target=row["tgt_file_tbl"],
            keys=_list(row["src_keys"]),
            surrogate=row["surrogatekey"],
            driving_table=row["driving_table"],
            driving_keys=_list(row["driving_table_pk"]),
            query=row["tfm_query"],
            exclusions=_list(row["scdexclusions"]),
            lookups=tuple(tuple(part.split(":")) for part in _list(row[LOOKUPS.lower()])),
        )

    def rows(
        self, spark: SparkSession, catalog: str | None = None, schema: str | None = None
    ) -> DataFrame:
        """Result of the job's query."""
        return spark.sql(render_sql(self.query, catalog, schema))

    def rows_of(self, driving: DataFrame) -> DataFrame | None:
        """Result of the job's query with ``driving`` in place of the driving table; None if the
        query names that table more than once, so that it is joined with itself."""
        name = re.compile(rf"(?:@catalog\.)?(?:@src_schema\.)?\b{re.escape(self.driving_table)}\b", re.IGNORECASE)
        if len(name.findall(self.query)) != 1:
            return None
        view = f"{self.driving_table}_{uuid.uuid4().hex}"
        driving.createOrReplaceTempView(view)
        rows = driving.sparkSession.sql(render_sql(name.sub(view, self.query)))
        driving.sparkSession.catalog.dropTempView(view)  # the analysed plan does not need the name
        return rows
