"""A run: sources to raw, raw to curated, curated to reports. `python -m tallyworks` is its command line."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import dedupe_latest
from ..sources import extract, workbook
from ..sources.contract import Contract
from ..sources.export import export
from ..sources.lake import Lake
from . import coach, curation, data_tests, models, rebuild, staging
from .analyses import ANALYSES
from .assertions import broken

C = F.col
SHEET = "Betreuung"


@dataclass(frozen=True)
class Dataset:
    fields: tuple[str, ...]
    key: str
    path: str = ""
    filter: str = ""
    mark: str = ""


# fixed values: the sources' fields and addresses
DATASETS = {
    "trainings": Dataset(("training_id", "training_name", "track", "variant", "duration_weeks", "list_price_eur", "is_active", "modules"), "training_id", "/trainings"),
    "participants": Dataset(("participant_id", "first_name", "last_name", "email", "birth_date", "city", "federal_state", "funding_type", "acquisition_channel", "created_at", "modified_at"), "participant_id", "/participants", "modified_after", "modified_at"),
    "enrollments": Dataset(("enrollment_id", "participant_id", "training_id", "cohort_start_date", "planned_end_date", "status", "status_changed_at", "created_at", "modified_at"), "enrollment_id", "/enrollments", "modified_after", "modified_at"),
    "progress_events": Dataset(("event_id", "enrollment_id", "module_id", "event_type", "event_time"), "event_id", "/progress-events", "since", "event_time"),
    "survey_responses": Dataset(("response_id", "enrollment_id", "survey_type", "survey_week", "question_key", "answer_value", "submitted_at"), "response_id", "/survey-responses", "since", "submitted_at"),
    "coach_rows": Dataset(coach.FIELDS, "coach_assignment_id"),
}
LOG = "snapshot_date string, dataset string, run_id string, status string, load_mode string, watermark string, fingerprint string, records_fetched bigint, row_count bigint, error string"
TESTS = "snapshot_date string, run_id string, model string, test string, severity string, failures bigint"
RUNS = "run_id string, snapshot_date string, layer string, status string, started_at string, finished_at string, error string"
LINEAGE = {"_run_id": "string", "_page_number": "int", "_source_row_number": "int", "_ingested_at": "timestamp", "_source_as_of": "string"}
#: what every curated row must have, whatever else its table holds
CURATED_CONTRACT = {"_run_id": "string!", "_ingested_at": "timestamp!", "_snapshot_date": "date!", "payload_hash": "string!", "duplicate_id_count": "bigint!", "duplicate_payload_count": "bigint!", "quality_flags": "array<string>!", "validation_status": "string!", "is_quarantined": "boolean!"}
NEEDED = {"meta_extraction_log": ("snapshot_date", "dataset", "run_id", "status", "load_mode", "records_fetched", "row_count"), "meta_curation_log": ("snapshot_date", "dataset", "curated_from", "row_count")}
STATUSES = ("LOADED", "NO_CHANGES", "FAILED")
CURATED = "snapshot_date string, dataset string, curated_from string, row_count bigint"


def check_log(name: str, row: dict) -> None:
    """A log row has what its log needs, a known status, and an error if it failed."""
    if name not in NEEDED:
        return
    # a load that failed has counted nothing
    needed = NEEDED[name][:4] if row.get("status") == "FAILED" else NEEDED[name]
    if missing := [c for c in needed if row.get(c) is None]:
        raise ValueError(f"{name}: a row without {missing}")
    if name == "meta_extraction_log":
        if row["status"] not in STATUSES:
            raise ValueError(f"{name}: status {row['status']}, expected one of {STATUSES}")
        if row["status"] == "FAILED" and not row.get("error"):
            raise ValueError(f"{name}: a failed load without its error")


@dataclass
class Run:
    spark: SparkSession
    lake: Lake
    day: str
    as_of: str = "2026-08-31"
    full: bool = False
    allow_shrink: bool = False
    rebuild: bool = False
    page_size: int = 500
    #: staging reads curated days from this one on, instead of from its newest
    from_day: str | None = None
    full_models: bool = False

    def __post_init__(self):
        self.run_id, self.at = uuid.uuid4().hex, datetime.now(UTC)

    def log(self, name: str) -> list[dict]:
        return [r.asDict() for r in self.lake.read(name).collect()] if name in self.lake.names() else []

    def note(self, name: str, schema: str, rows: list[dict], keys: list[str]) -> None:
        """Log rows replace those of the same keys; a log has one row a day and dataset, or a run."""
        columns = [c.split()[0] for c in schema.split(", ")]
        for r in rows:
            check_log(name, r)
        if rows:
            self.lake.upsert(name, self.spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema).coalesce(1), keys, buckets=1)

    def _frame(self, name: str, records: list[dict], lineage: list[tuple[int | None, int]], as_of: str | None = None) -> DataFrame:
        fields = DATASETS[name].fields
        kind = lambda f: curation.MODULES if f == "modules" else "string"
        value = lambda r, f: r.get(f) if f == "modules" else extract.to_text(r.get(f))
        schema = ", ".join(f"`{f}` {kind(f)}" for f in fields) + "".join(f", {n} {t}" for n, t in LINEAGE.items())
        return self.spark.createDataFrame([(*[value(r, f) for f in fields], self.run_id, page, row, self.at, as_of) for r, (page, row) in zip(records, lineage, strict=True)], schema)

    def _earlier(self, name: str) -> DataFrame | None:
        days = [d for d in self.lake.days(f"raw_{name}") if d < self.day]
        return self.lake.read(f"raw_{name}").where(C("_snapshot_date") < F.lit(self.day).cast("date")) if days else None

    def fetch(self, name: str, client, book: str | None, log: list[dict]) -> tuple[dict, DataFrame | None]:
        """The log row of one dataset and the frame to store; a frame of None stores nothing."""
        as_of = None
        d, row = DATASETS[name], {"snapshot_date": self.day, "dataset": name, "run_id": self.run_id, "load_mode": "full"}
        if not d.mark:
            if d.path:
                answer = client.get(d.path)
                records, as_of = answer.get("data"), extract.to_text(answer.get("as_of"))
                if not isinstance(records, list) or not all(isinstance(r, dict) for r in records):
                    raise ValueError(f"{d.path}: no list of objects under data")
                if records:
                    extract.check_contract(records, list(d.fields))
                row["fingerprint"], lineage = extract.fingerprint(records), [(1, i + 1) for i in range(len(records))]
            else:
                data = Path(book or "").read_bytes()
                records = workbook.read_sheet(data, SHEET, list(d.fields))
                row["fingerprint"], lineage = hashlib.sha256(data).hexdigest(), [(None, r["_source_row_number"]) for r in records]
            before = [r for r in sorted(log, key=lambda r: r["snapshot_date"]) if r["dataset"] == name and r["snapshot_date"] < self.day and r["status"] == "LOADED"]
            same = bool(before) and before[-1]["fingerprint"] == row["fingerprint"] and not self.full
            kept = self._frame(name, records, lineage, as_of) if records and not same else None
        else:
            mark = None if self.full else extract.watermark(log, name, self.day)
            row["load_mode"] = "incremental" if mark else "full"
            records, pages = client.fetch_all(d.path, {d.filter: mark} if mark else {}, self.page_size)
            stored = self._earlier(name)
            if not mark and stored is not None:
                extract.check_shrink(stored.select(d.key).distinct().count(), len(records), self.allow_shrink)
            if records:
                extract.check_contract(records, list(d.fields))
            newest = extract.newest([extract.to_text(r.get(d.mark)) for r in records])
            row["watermark"] = extract.newest([mark, newest]) if mark else newest
            kept = self._frame(name, records, [(p, i + 1) for i, p in enumerate(pages)]) if records else None
            if kept is not None and mark and stored is not None:
                # the filter takes the mark in: what is stored of it with equal content goes
                at = stored.where(C(d.mark) == mark).select(*[C(f).alias(f"_s_{f}") for f in d.fields]).distinct()
                kept = kept.join(at, reduce(lambda a, b: a & b, [C(f).eqNullSafe(C(f"_s_{f}")) for f in d.fields]), "left_anti")
        count = kept.count() if kept is not None else 0
        return row | {"status": "LOADED" if count else "NO_CHANGES", "records_fetched": len(records), "row_count": count}, kept if count else None

    def raw(self, client, book: str | None) -> list[dict]:
        """All datasets; one that fails leaves the others, and what this day has of it already. One commit stores them."""
        log, rows, tables = self.log("meta_extraction_log"), [], {}
        for name in DATASETS:
            try:
                row, frame = self.fetch(name, client, book, log)
                tables[f"raw_{name}@{self.day}"] = frame if frame is None else frame.withColumn("_snapshot_date", F.lit(self.day).cast("date"))
            except Exception as e:  # noqa: BLE001 - any failure of a source is its own log row
                row = {"snapshot_date": self.day, "dataset": name, "run_id": self.run_id, "status": "FAILED", "error": f"{type(e).__name__}: {e}"}
            rows.append(row)
        self.lake.commit(tables)
        loaded = {r["dataset"] for r in log if r["snapshot_date"] == self.day and r["status"] == "LOADED"}
        self.note("meta_extraction_log", LOG, [r for r in rows if not (r["status"] == "FAILED" and r["dataset"] in loaded)], ["snapshot_date", "dataset"])
        return rows

    def _history(self, name: str) -> DataFrame:
        lake = self.lake
        return lake.read(f"raw_{name}") if lake.days(f"raw_{name}") else self._frame(name, [], []).withColumn("_snapshot_date", F.lit(self.day).cast("date"))

    def curate(self) -> dict[str, int]:
        """Raw days that are new, or all; references are looked up in the whole history. Curated days without a raw one go."""
        done = {(r["dataset"], r["snapshot_date"]): r["curated_from"] for r in self.log("meta_curation_log")}
        come = {(r["dataset"], r["snapshot_date"]): r["run_id"] for r in self.log("meta_extraction_log") if r["status"] == "LOADED"}
        gone = {f"curated_{n}@{d}": (n, d) for n in DATASETS for d in self.lake.days(f"curated_{n}") if (n, d) not in come}
        todo = [k for k, run in sorted(come.items()) if self.rebuild or done.get(k) != run]
        contracts = {f"curated_{n}": Contract(CURATED_CONTRACT, open=True) for n in DATASETS}
        with self.lake.scratch() as folder:
            steps = self._steps(folder) if todo else {}
            tables: dict[str, DataFrame | None] = dict.fromkeys(gone)
            for name, day in todo:
                tables[f"curated_{name}@{day}"] = steps[name](self.lake.read_day(f"raw_{name}", day), day).withColumn("_snapshot_date", F.lit(day).cast("date"))
            self.lake.commit(tables, contracts)
        counts = {f"{n}@{d}": self.lake.read_day(f"curated_{n}", d).count() for n, d in todo}
        self.note("meta_curation_log", CURATED, [{"snapshot_date": d, "dataset": n, "curated_from": come[n, d], "row_count": counts[f"{n}@{d}"]} for n, d in todo], ["snapshot_date", "dataset"])
        if gone:
            self._forget("meta_curation_log", [*gone.values()])
        return counts

    def _forget(self, log: str, rows: list[tuple[str, str]]) -> None:
        """The log is the list of what there is: rows of dropped days leave it."""
        kept = self.lake.read(log).where(~F.struct("dataset", "snapshot_date").isin([F.struct(F.lit(n), F.lit(d)) for n, d in rows]))
        self.lake.publish(self.lake.merge(log, kept, ["snapshot_date", "dataset"], lambda old, new: new, touch=self.lake.read(log)))

    def _steps(self, folder: str) -> dict[str, Callable[[DataFrame, str], DataFrame]]:
        """How a day of each dataset is curated. What references are looked up in is written to folder, once."""

        def kept(name: str, df: DataFrame) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        plain = lambda n, df: df.select(*[C(f"`{f}`") for f in DATASETS[n].fields], *LINEAGE)
        newest = lambda n: dedupe_latest(self._history(n), [DATASETS[n].key], [C("_snapshot_date").desc(), C("_source_row_number").desc(), C("_run_id")])
        trainings = kept("trainings", curation.trainings(plain("trainings", newest("trainings"))))
        everyone = plain("participants", self._history("participants"))
        people = kept("people", curation.participants(plain("participants", newest("participants")), self.as_of))
        enrolled = kept("enrolled", curation.enrollments(plain("enrollments", newest("enrollments")), people, trainings, self.as_of))
        return {
            "trainings": lambda df, _: curation.trainings(plain("trainings", df)),
            "participants": lambda df, _: curation.participants(plain("participants", df), self.as_of, everyone),
            "enrollments": lambda df, _: curation.enrollments(plain("enrollments", df), people, trainings, self.as_of),
            "progress_events": lambda df, _: curation.progress_events(plain("progress_events", df), enrolled, curation.modules(trainings)),
            "survey_responses": lambda df, _: curation.survey_responses(plain("survey_responses", df), enrolled),
            "coach_rows": lambda df, day: coach.assignments(df, people, enrolled, "coach_rows", day),
        }

    def stage(self) -> None:
        """Staging up to date: from the newest day of each model, from --from-day, or from scratch."""
        staging.build(self.lake, self.from_day, self.full_models)

    def _inputs(self, lake: Lake) -> dict[str, DataFrame]:
        return {into: lake.read(name) for name, into in data_tests.STAGES.items()}

    def models(self, store: Callable[[str, DataFrame], DataFrame] | None = None) -> models.Context:
        """The models over staging; store keeps one under its name and gives it back."""
        return models.Context(self._inputs(self.lake), self.as_of, store=store)

    def check(self, context: models.Context) -> list[dict]:
        """Every data test of the models, and that staging has the keys of the curated days; noted in the lake."""
        # instants may lie two days beyond the reporting date at most
        high = (date.fromisoformat(self.as_of) + timedelta(days=2)).isoformat()
        found = data_tests.evaluate(lambda n: context[data_tests.STAGES.get(n, n)], data_tests.rules(high=high))
        for name in staging.NAMES:
            spec = staging.specs()[name]
            curated = staging.source(self.lake, name, staging.days(self.lake, spec.dataset)).select(*spec.keys)
            found = found.unionByName(data_tests.parity(name, curated, context[data_tests.STAGES[name]], [*spec.keys]))
        rows = [r.asDict() | {"snapshot_date": self.day, "run_id": self.run_id} for r in found.collect()]
        self.note("meta_data_tests", TESTS, rows, ["snapshot_date", "model", "test"])
        return rows

    def build(self) -> models.Context:
        """Write every model, test what was written, and only then make it live, in one commit. What breaks raises, and the last
        build stays."""
        paths: dict[str, str | None] = {}

        def store(name: str, df: DataFrame) -> DataFrame:
            paths[name] = self.lake.stage(name, df)
            return self.spark.read.schema(df.schema).parquet(paths[name])

        context = self.models(store)
        failed = {f"{r['model']}: {r['test']}": r["failures"] for r in self.check(context) if r["failures"] and r["severity"] == "error"}
        failed |= broken(context)
        if failed:
            raise ValueError(f"broken by rows: {failed}")
        for name in models.MODELS:
            context[name]
        self.lake.publish(paths, whole=True)
        return context

    def verify(self) -> list[str]:
        """What a second build changes, and where an incremental staging differs from one made from scratch; nothing, if all is well."""
        tables = [*data_tests.STAGES, *models.MODELS]
        self.stage()
        self.build()
        first = self.lake.versions()[-1]
        self.stage()
        self.build()
        again = self.lake.versions()[-1]
        staging.build(self.lake, full=True)
        self.build()
        whole = self.lake.versions()[-1]
        at = lambda v: rebuild.fingerprints(self.lake.at(v), tables)
        one = at(first)
        return [f"second build: {x}" for x in rebuild.differences(one, at(again))] + [f"full build: {x}" for x in rebuild.differences(one, at(whole))]

    def run(self, layer: str, client=None, book: str | None = None, out: str | None = None) -> int:
        """Exit code: 0 all went well, 1 the run failed, 2 some datasets failed and the rest is loaded (no reports then)."""
        now = lambda: datetime.now(UTC).isoformat(timespec="seconds")
        row = {"run_id": self.run_id, "snapshot_date": self.day, "layer": layer, "status": "RUNNING", "started_at": now()}
        self.note("meta_runs", RUNS, [row], ["run_id"])
        try:
            failed = [r for r in (self.raw(client, book) if layer in ("raw", "all") else []) if r["status"] == "FAILED"]
            if layer in ("curated", "all"):
                self.curate()
            if layer in ("reports", "all") and out and not failed:
                self.stage()
                context = self.build()
                export({name: (title, table(context)) for name, (title, table) in ANALYSES.items()}, out)
            if layer == "verify" and (found := self.verify()):
                raise ValueError("; ".join(found))
        except Exception as e:  # noqa: BLE001 - logged and told by the exit code
            self.note("meta_runs", RUNS, [row | {"status": "FAILED", "finished_at": now(), "error": f"{type(e).__name__}: {e}"}], ["run_id"])
            return 1
        why = "; ".join(f"{r['dataset']}: {r['error']}" for r in failed) or None
        self.note("meta_runs", RUNS, [row | {"status": "PARTIAL_SUCCESS" if failed else "SUCCESS", "finished_at": now(), "error": why}], ["run_id"])
        return 2 if failed else 0
