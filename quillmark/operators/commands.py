"""Steps by command or request: their options, where the stores are, jobs, and a small web application over them.

An option that a step does not read is refused, never ignored. A request may not set what acts on files or throws rows
away. The application is a plain WSGI callable, so any server can run it, and needs no framework.
"""

from __future__ import annotations

import json
import os
import threading
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from quillmark.operators.relational import Refused

STEPS = ("scope", "cut", "summary", "companies", "sector", "category", "sentiment", "snapshot", "period")
RESULTS_ENV, SOURCE_ENV, DEFAULT_RESULTS = "QUILLMARK_RESULTS", "QUILLMARK_SOURCE", "data/results"
#: Largest request in bytes, read in parts so that a declared length is not trusted.
MOST_BODY = 1 << 20


def results_folder(given: str | None = None, env: Mapping[str, str] = os.environ) -> str:
    """From the argument, the environment, or the default."""
    return given or env.get(RESULTS_ENV) or DEFAULT_RESULTS


def source_folder(given: str | None = None, env: Mapping[str, str] = os.environ) -> str | None:
    return given or env.get(SOURCE_ENV) or None


@dataclass(frozen=True)
class Option:
    """``steps``: those that read it; ``local``: not by request; ``needs``: another option that must be set."""

    kind: type
    steps: tuple[str, ...] = STEPS
    choices: tuple = ()
    least: int | None = None
    local: bool = False
    needs: str | None = None


OPTIONS = {
    "limit": Option(int, least=1),
    "status": Option(bool),
    "items": Option(str, ("summary", "companies"), ("single", "sub_news", "sector")),
    "reading": Option(str, ("cut",), ("sentences", "units", "units5")),
    "scope_revision": Option(str, ("cut", "summary", "companies", "sector")),
    "cut_revision": Option(str, ("summary", "companies", "snapshot")),
    "summary_revision": Option(str, ("companies", "category", "sentiment", "snapshot")),
    "companies_revision": Option(str, ("category", "sentiment", "snapshot")),
    "category_revision": Option(str, ("snapshot",)),
    "sentiment_revision": Option(str, ("snapshot",)),
    "sector_revision": Option(str, ("summary", "snapshot")),
    "snapshot_revision": Option(str, ("period",)),
    "summariser": Option(str, ("summary",), ("local", "remote")),
    "max_calls": Option(int, ("summary",), least=1),
    "concurrency": Option(int, ("summary",), least=1),
    "period_end": Option(str, ("period",)),
    "catch_up": Option(bool, ("period",)),
    "model_dir": Option(str, ("scope", "cut"), local=True),
    "fetch": Option(bool, ("scope", "cut"), local=True, needs="model_dir"),
    "allow_unpinned": Option(bool, ("scope", "cut"), local=True, needs="model_dir"),
    "reset": Option(bool, local=True),
    "source": Option(str, local=True),
    "results": Option(str, local=True),
}


def _value(name: str, option: Option, raw: object) -> object:
    if option.kind is bool:
        if raw not in (True, False):
            raise Refused(f"{name} is a flag")
        return raw
    try:
        value = option.kind(raw)
    except (TypeError, ValueError):
        raise Refused(f"{name}: {raw!r} is no {option.kind.__name__}") from None
    if option.choices and value not in option.choices:
        raise Refused(f"{name}: one of {', '.join(map(str, option.choices))}")
    if option.least is not None and value < option.least:
        raise Refused(f"{name} must be at least {option.least}")
    return value


def checked(step: str, options: Mapping[str, object], request: bool = False) -> dict[str, object]:
    """The options of a step that are set, each of its kind; refused where the step does not read one or a request may not set it."""
    if step not in STEPS:
        raise Refused(f"unknown step {step!r}: one of {', '.join(STEPS)}")
    out: dict[str, object] = {}
    for raw, value in options.items():
        name = raw.replace("-", "_")
        if name not in OPTIONS:
            raise Refused(f"unknown option {raw!r}")
        if value is None or value is False:
            continue
        option = OPTIONS[name]
        if request and option.local:
            raise Refused(f"{raw} is for the command line only")
        if step not in option.steps:
            raise Refused(f"{raw} only applies to {', '.join(option.steps)}")
        out[name] = _value(name, option, value)
    for name in out:
        if (needed := OPTIONS[name].needs) and needed not in out:
            raise Refused(f"{name} needs {needed}")
    return out


def to_argv(step: str, options: Mapping[str, object]) -> list[str]:
    """A step's options as a command line."""
    flags = ((f"--{name.replace('_', '-')}", value) for name, value in checked(step, options).items())
    return ["--step", step, *[x for flag, value in flags for x in ([flag] if value is True else [flag, str(value)])]]


def from_argv(argv: Sequence[str]) -> tuple[str, dict[str, object]]:
    """The step and options of a command line; names are whole, never shortened."""
    step, options, words = None, {}, list(argv)
    while words:
        word = words.pop(0)
        name, given, value = word.removeprefix("--").replace("-", "_").partition("=")
        if not word.startswith("--") or (name != "step" and name not in OPTIONS):
            raise Refused(f"unknown argument {word!r}")
        if name in options or (name == "step" and step is not None):
            raise Refused(f"{word} is given twice")
        if name != "step" and OPTIONS[name].kind is bool:
            if given:
                raise Refused(f"{name} is a flag")
            options[name] = True
            continue
        if not given:
            if not words or words[0].startswith("--"):
                raise Refused(f"{word} needs a value")
            value = words.pop(0)
        if name == "step":
            step = value
        else:
            options[name] = value
    if step is None:
        raise Refused("--step is required")
    return step, checked(step, options)


@dataclass
class Service:
    """Steps as functions of their options, run one job at a time in the background; loaded models by name."""

    steps: Mapping[str, Callable[[dict], object]]
    status: Mapping[str, Callable[[], object]] = field(default_factory=dict)
    models: dict[str, Callable[[list], list]] = field(default_factory=dict)
    jobs: dict[str, dict] = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def start(self, plan: Sequence[tuple[str, Mapping[str, object]]]) -> dict:
        """Check every step of a plan, then run it; refused while another job runs."""
        ready = [(step, checked(step, options, request=True)) for step, options in plan]
        if missing := [step for step, _ in ready if step not in self.steps]:
            raise Refused(f"no such steps here: {missing}")
        with self._lock:
            if any(j["state"] == "running" for j in self.jobs.values()):
                raise Refused("a job is running")
            job = {"id": uuid.uuid4().hex, "state": "running", "plan": [s for s, _ in ready], "done": [], "cancel": False, "error": None}
            self.jobs[job["id"]] = job
        job["thread"] = threading.Thread(target=self._work, args=(job, ready), daemon=True)
        job["thread"].start()
        return job

    def _work(self, job: dict, plan) -> None:
        state = "done"
        try:
            for step, options in plan:
                if job["cancel"]:
                    state = "cancelled"
                    break
                job["done"].append({"step": step, "result": self.steps[step](options)})
        except Exception as e:  # a job's failure is its result
            state, job["error"] = "failed", f"{type(e).__name__}: {e}"[:500]
        job["state"] = state

    def shown(self, job: dict) -> dict:
        return {k: v for k, v in job.items() if k not in ("thread", "cancel")}

    def answer(self, method: str, path: str, body: dict) -> tuple[int, object]:
        """Status and content of a request."""
        parts = [p for p in path.split("/") if p]
        match (method, *parts):
            case ("GET", "health"):
                return 200, {"ok": True, "running": [j["id"] for j in self.jobs.values() if j["state"] == "running"]}
            case ("GET", "steps"):
                return 200, {s: sorted(n for n, o in OPTIONS.items() if s in o.steps and not o.local) for s in self.steps}
            case ("GET", "steps", step, "status") if step in self.status:
                return 200, self.status[step]()
            case ("POST", "steps", step, "run") if step in self.steps:
                return 202, self.shown(self.start([(step, body.get("options") or {})]))
            case ("POST", "pipeline", "run"):
                return 202, self.shown(self.start([(x["step"], x.get("options") or {}) for x in body["steps"]]))
            case ("GET", "jobs"):
                return 200, [self.shown(j) for j in self.jobs.values()]
            case ("GET", "jobs", name) if name in self.jobs:
                return 200, self.shown(self.jobs[name])
            case ("POST", "jobs", name, "cancel") if name in self.jobs:
                self.jobs[name]["cancel"] = True
                return 202, self.shown(self.jobs[name])
            case ("GET", "models"):
                return 200, sorted(self.models)
            case ("POST", "models", name, "predict") if name in self.models:
                return 200, self.models[name](list(body["inputs"]))
        return 404, {"error": f"nothing at {method} {path}"}

    def __call__(self, environ: dict, start_response) -> Iterable[bytes]:
        """The application by the WSGI convention."""
        try:
            raw, source = b"", environ["wsgi.input"]
            if environ["REQUEST_METHOD"] == "POST":
                most = min(int(environ.get("CONTENT_LENGTH") or 0), MOST_BODY + 1)
                raw = source.read(most)
            if len(raw) > MOST_BODY:
                code, content = 413, {"error": f"a request has at most {MOST_BODY} bytes"}
            else:
                code, content = self.answer(environ["REQUEST_METHOD"], environ.get("PATH_INFO", "/"), json.loads(raw) if raw else {})
        except Refused as e:
            code, content = 409, {"error": str(e)}
        except (ValueError, KeyError, TypeError) as e:
            code, content = 400, {"error": f"{type(e).__name__}: {e}"}
        data = json.dumps(content, default=str).encode()
        start_response(f"{code} {'OK' if code < 400 else 'Refused'}", [("Content-Type", "application/json"), ("Content-Length", str(len(data)))])
        return [data]
