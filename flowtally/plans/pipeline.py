"""Declared pipelines: a list of steps becomes one DataFrame and one sink.

Each kind of step is described once: its options, the columns it gives and what it does.
Everything that can be refused is refused from these descriptions, before a row is read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession

from flowtally.functions.clock import UNIT_SECONDS, check_range
from flowtally.functions.networks import parse_networks
from flowtally.operators.aggregate import aggregate, at_least, group_columns, ordered
from flowtally.operators.collect import CollectRules
from flowtally.operators.counters import RunCounters, threshold_counters, window_counters
from flowtally.operators.merge import MERGE_WAYS
from flowtally.operators.resolve import resolve
from flowtally.operators.resolvers import get_resolver
from flowtally.operators.split import with_label, with_slice
from flowtally.operators.trim import kept_columns, trim
from flowtally.plans.settings import Settings
from flowtally.schema import COLLECT_COLUMNS, DEFAULT_KEY_COLUMN, RESOLVE_COLUMNS
from flowtally.session import stage, stage_scope
from flowtally.sources.registry import get_source
from flowtally.sources.tables import READ_MODES, merge_files, read_csv, write_csv, write_split

# -- options -----------------------------------------------------------------------

Reader = Callable[[Any], Any]


def whole(value: Any) -> int | None:
    if value is None:
        return None
    if isinstance(value, bool) or not str(value).lstrip("-").isdigit():
        raise ValueError(f"{value!r} is no whole number")
    return int(value)


def number(value: Any) -> int:
    if value is None:
        raise ValueError("a whole number is needed")
    return whole(value)


def optional_text(value: Any) -> str | None:
    if not isinstance(value, str | None):
        raise ValueError(f"{value!r} is no text")
    return value


def text(value: Any) -> str:
    if not isinstance(value, str) or not value:
        raise ValueError("a text is needed")
    return value


def switch(value: Any) -> bool:
    if not isinstance(value, bool):
        raise ValueError(f"{value!r} is neither true nor false")
    return value


def paths(value: Any) -> tuple[str, ...]:
    if isinstance(value, str) or not isinstance(value, Sequence) or not all(isinstance(one, str) for one in value):
        raise ValueError(f"a list of paths is needed, not {value!r}")
    return tuple(value)


def choice(*known: str) -> Reader:
    def read(value: Any) -> str:
        if value not in known:
            raise ValueError(f"{value!r} is none of {', '.join(known)}")
        return value

    return read


RANGE = {"start": (number, 1), "end": (number, 0), "time_unit": (choice(*UNIT_SECONDS), "h")}

# -- kinds of steps ----------------------------------------------------------------

Options = Mapping[str, Any]
Columns = list[str] | None  # None where only reading a file would tell


@dataclass(frozen=True)
class Run:
    """What steps share; ``fresh`` gathers answers for the cache, ``counters`` what the run
    counts, if it does."""

    spark: SparkSession
    settings: Settings
    counters: RunCounters | None = None
    fresh: list[DataFrame] = field(default_factory=list)


@dataclass(frozen=True)
class Kind:
    """``options`` maps a name to its reader and default. ``columns`` tells the columns
    after the step, and raises ValueError for what could not run."""

    options: Mapping[str, tuple[Reader, Any]]
    columns: Callable[[Settings, Columns, Options], Columns]
    apply: Callable[[Run, Any, Options], DataFrame]
    starts: bool = False


def _rules(settings: Settings, options: Options) -> CollectRules:
    check_range(options["start"], options["end"])
    return CollectRules(
        now=settings.now,
        start=options["start"],
        end=options["end"],
        unit=options["time_unit"],
        stream_id=settings.stream_id,
        allowlist=settings.allowlist,
        cidrs=settings.cidrs,
        match_mode=settings.match_mode,
    )


def _source(settings: Settings, options: Options):
    return get_source(options["source"] or settings.source)


def _collect_columns(settings: Settings, before: Columns, options: Options) -> Columns:
    _source(settings, options)
    _rules(settings, options)
    return COLLECT_COLUMNS


def _merge_columns(settings: Settings, before: Columns, options: Options) -> Columns:
    if before is None and not options["inputs"]:
        raise ValueError("nothing to merge")
    return None if options["inputs"] else before


def _aggregate_columns(settings: Settings, before: Columns, options: Options) -> Columns:
    return None if before is None else [*group_columns(before), "count"]


def _resolver(settings: Settings, options: Options):
    workers = {} if options["workers"] is None else {"workers": options["workers"]}
    return get_resolver(options["resolver"] or settings.resolver, settings.tables, **settings.resolver_options, **workers)


def _resolve_columns(settings: Settings, before: Columns, options: Options) -> Columns:
    _resolver(settings, options)
    if before is None:
        return None
    if options["key_column"] not in before:
        raise ValueError(f"no column {options['key_column']!r} to look up; there are {', '.join(before)}")
    return [*before, *(name for name in RESOLVE_COLUMNS if name not in before)]


def _resolve(run: Run, frame: DataFrame, options: Options) -> DataFrame:
    store = run.settings.cache if options["cache"] else None
    known = None if store is None else store.read()
    resolver = _resolver(run.settings, options)
    tasks = getattr(store, "buckets", None)
    found = resolve(frame, resolver, options["key_column"], known, run.settings.now, counters=run.counters, tasks=tasks)
    if store is not None:
        run.fresh.append(found.fresh)
    return found.rows


def _collect(run: Run, frame: Any, options: Options) -> DataFrame:
    rules = _rules(run.settings, options)
    rows = _source(run.settings, options)(run.spark, rules)
    if run.counters is None:
        return rows
    return run.counters.watch("collect", rows, **window_counters(rules.now, rules.start, rules.end, rules.unit))


def _aggregate(run: Run, frame: DataFrame, options: Options) -> DataFrame:
    least = run.settings.min_count if options["min_count"] is None else options["min_count"]
    if run.counters is None:
        return aggregate(frame, least)
    return at_least(run.counters.watch("aggregate", aggregate(frame), **threshold_counters(least)), least)


KINDS = {
    "collect": Kind(
        {"source": (optional_text, None), **RANGE},
        _collect_columns,
        _collect,
        starts=True,
    ),
    "trim": Kind(
        {},
        lambda settings, before, options: None if before is None else kept_columns(before),
        lambda run, frame, options: trim(frame),
    ),
    "merge": Kind(
        {
            "inputs": (paths, ()),
            "how": (choice(*MERGE_WAYS), "name"),
            "multiline": (switch, True),
            "mode": (choice(*READ_MODES), "PERMISSIVE"),
        },
        _merge_columns,
        lambda run, frame, o: merge_files(run.spark, o["inputs"], o["how"], o["multiline"], o["mode"], frame),
        starts=True,
    ),
    "aggregate": Kind(
        {"min_count": (whole, None), "out_dir": (optional_text, None), **RANGE},
        _aggregate_columns,
        _aggregate,
    ),
    "resolve": Kind(
        {
            "resolver": (optional_text, None),
            "key_column": (text, DEFAULT_KEY_COLUMN),
            "workers": (whole, None),  # threads a task of a row function uses; others ignore it
            "cache": (switch, True),
        },
        _resolve_columns,
        _resolve,
    ),
}

# -- reading a declaration ---------------------------------------------------------


@dataclass(frozen=True)
class Step:
    name: str
    options: Options

    @property
    def kind(self) -> Kind:
        return KINDS[self.name]


def parse_steps(declared: Any, overrides: Mapping[str, Any] | None = None) -> list[Step]:
    """The steps with all options read, or ValueError. An override holds in every step that
    has the option."""
    if not isinstance(declared, list) or not declared:
        raise ValueError("A pipeline is a list of at least one step")
    return [_parse_step(item, overrides or {}) for item in declared]


def _parse_step(item: Any, overrides: Mapping[str, Any]) -> Step:
    pairs = [(item, None)] if isinstance(item, str) else list(item.items()) if isinstance(item, dict) else []
    if len(pairs) != 1:
        raise ValueError(f"Not a step: {item!r}. Write its name, or its name with options")
    ((name, given),) = pairs
    if name not in KINDS:
        raise ValueError(f"There is no step {name!r}, only {', '.join(KINDS)}")
    given = {} if given is None else given
    if not isinstance(given, dict):
        raise ValueError(f"{name}: options are written as 'option: value', not {given!r}")
    options = KINDS[name].options
    if strange := [str(key) for key in given if key not in options]:
        raise ValueError(f"{name}: no option {', '.join(sorted(strange))}; it has {', '.join(options) or 'none'}")
    read = {}
    for key, (reader, default) in options.items():
        value = overrides[key] if key in overrides else given.get(key, default)
        try:
            read[key] = reader(value)
        except ValueError as error:
            raise ValueError(f"{name}, {key}: {error}") from None
    return Step(name, MappingProxyType(read))


def load_steps(path: str) -> Any:
    """The step list of a YAML file."""
    import yaml

    with open(path, encoding="utf-8") as lines:
        return yaml.safe_load(lines)


# -- running -----------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """The final rows: lazy, but for resolve steps, which have looked their keys up; the options of the split an aggregate step asked for, if any;
    whether ``count`` is a count of this run; and answers the cache does not have yet."""

    frame: DataFrame
    split: Options | None
    counted: bool
    fresh: list[DataFrame]


def _asked_split(steps: Sequence[Step]) -> Options | None:
    return next((step.options for step in reversed(steps) if step.options.get("out_dir")), None)


def check(steps: Sequence[Step], settings: Settings, columns: Columns, given: bool) -> None:
    """Refuse what cannot run, without a job. ``given`` tells whether there is an input,
    ``columns`` its columns as far as known."""
    if _asked_split(steps) is not None and not parse_networks(settings.cidrs):
        raise ValueError("A split by subnet needs networks: settings.cidrs is empty")
    for step in steps:
        if not given and not step.kind.starts:
            raise ValueError(f"{step.name}: there is no input")
        try:
            columns, given = step.kind.columns(settings, columns, step.options), True
        except ValueError as error:
            raise ValueError(f"{step.name}: {error}") from None


def plan(
    spark: SparkSession,
    declared: Any,
    frame: DataFrame | None = None,
    overrides: Mapping[str, Any] | None = None,
    settings: Settings | None = None,
    counters: RunCounters | None = None,
    staged: bool = False,
) -> Plan:
    """Fold the steps over ``frame``. A frame that a resolve step follows is staged when
    an aggregate made it, because resolve reads its rows twice; a resolve step looks its
    keys up right away, into stage tables. The cache is not touched.

    ``counters`` are complete once the frame has been read. ``staged`` stages every
    aggregate, which a sort of its rows would otherwise work out twice; counters need it."""
    settings = settings or Settings()
    steps = parse_steps(declared, overrides)
    check(steps, settings, None if frame is None else frame.columns, frame is not None)
    run = Run(spark, settings, counters)
    staged = staged or counters is not None
    counted = shuffled = False
    for step in steps:
        if step.name == "resolve" and shuffled:
            frame = stage(frame, "counted")
        frame = step.kind.apply(run, frame, step.options)
        if step.name == "aggregate" and staged:
            frame = stage(frame, "counted")
        shuffled = not staged and (step.name == "aggregate" or (shuffled and step.name == "trim"))
        counted = step.name == "aggregate" or (counted and step.name in ("trim", "resolve"))
    return Plan(frame, _asked_split(steps), counted, run.fresh)


def run_pipeline(
    spark: SparkSession,
    declared: Any,
    output: str | None = None,
    inputs: str | Sequence[str] | None = None,
    overrides: Mapping[str, Any] | None = None,
    settings: Settings | None = None,
    multiline: bool = True,
    counters: RunCounters | None = None,
) -> int:
    """Run a pipeline from CSV files to CSV files and return the number of rows written.
    ``counters``, if given, then holds what each step counted on the way.

    A requested split is applied to the final rows, so it holds what later steps add;
    ``output`` is then not used. New answers reach the cache once the rows are written.
    """
    settings = settings or Settings()
    steps = parse_steps(declared, overrides)
    if _asked_split(steps) is None and output is None:
        raise ValueError("Nowhere to write: give output, or out_dir in an aggregate step")
    reads = inputs is not None and steps[0].name != "collect"
    check(steps, settings, None, reads)
    with stage_scope(spark):
        frame = read_csv(spark, inputs, multiline=multiline) if reads else None
        planned = plan(spark, declared, frame, overrides, settings, counters, staged=True)
        written = _write(planned, output, settings)
        for fresh in planned.fresh:
            settings.cache.append(fresh)
        return written


def _write(planned: Plan, output: str | None, settings: Settings) -> int:
    """A count made by this run orders the rows; any other ``count`` is text like the rest."""
    seen = Observation("written")
    rows, part = planned.frame, planned.split
    if part is not None:
        labelled = with_label(rows, parse_networks(settings.cidrs))
        sliced = with_slice(labelled, settings.now, part["start"], part["end"], part["time_unit"])
        write_split(sliced, part["out_dir"], seen=seen, by_count=planned.counted)
    else:
        write_csv(ordered(rows) if planned.counted else rows, output, seen=seen)
    return seen.get["rows"]
