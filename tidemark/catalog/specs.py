"""Series the rule and panel queries are run on, one specification per series."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from tidemark.plans.alert_rules import RULES, Rule
from tidemark.plans.panels import PANELS


@dataclass(frozen=True)
class Spec:
    """A series: ``level`` is high while the measured load is above a limit that ``period`` sets, ``reset`` is the
    measured value itself, ``steps`` grows once per ``period`` events, ``seen`` is a timestamp ``level`` seconds old."""

    metric: str
    labels: tuple[tuple[str, str], ...]
    mode: str
    low: float
    high: float
    period: int

    @property
    def series(self) -> str:
        return json.dumps(dict(sorted(self.labels)), separators=(",", ":"))


def matches(rule_where, labels) -> bool:
    have = dict(labels)
    test = {
        "=": lambda v, t: v == t, "!=": lambda v, t: v != t,
        "=~": lambda v, t: re.fullmatch(t, v) is not None,
        "!~": lambda v, t: re.fullmatch(t, v) is None,
    }
    return all(test[op](have.get(name, ""), text) for name, op, text in rule_where)


def _labels(rule: Rule) -> dict[str, str]:
    """Labels that satisfy a rule's matchers."""
    free = {"datname": "shop", "fstype": "ext4", "name": "web", "dag_id": "daily", "outcome": "error"}
    return {n: (t if op == "=" else free[n]) for n, op, t in rule.where}


# How often a ratio's two sides and a gauge move, in events.
PERIODS = (150, 230, 310)


def _specs() -> list[Spec]:
    out: dict[tuple, Spec] = {}

    def add(metric, labels, mode, low=0.0, high=0.0, period=200):
        key = (metric, tuple(sorted(labels.items())))
        out.setdefault(key, Spec(metric, key[1], mode, low, high, period))

    for i, r in enumerate(RULES):
        labels, period = _labels(r), PERIODS[i % 3]
        if r.kind == "up":
            for n in range(int(r.limit) + 1):
                add(r.metric, {**labels, "instance": f"{labels['job']}-{n}"}, "level", 1, 0 if n < 2 else 1, period)
        elif r.kind in ("rate", "increase", "changes"):
            mode = "steps" if r.op == "==" or r.kind == "changes" else "reset"
            for n in range(2):
                add(r.metric, {**labels, "instance": f"node-{n}"}, mode, period=5 if r.kind == "changes" else period + n)
        elif r.kind == "stale":
            add(r.metric, labels, "seen", 0, r.limit + 60, period)
        elif r.kind == "ratio":
            share = r.limit / r.scale
            good, bad = (share * 0.5, share * 1.2) if r.op == ">" else (share * 2, share * 0.2)
            add(r.metric, {**labels, "instance": "a"}, "level", good * 64, bad * 64, period)
            add(r.other, {**labels, "instance": "a"}, "level", 64, 64, period)
        else:
            bad = {"==": r.limit, "!=": r.limit + 1, "<": r.limit - 1, ">": r.limit + 1}[r.op]
            good = {"==": r.limit + 1, "!=": r.limit, "<": r.limit + 1, ">": r.limit - 1}[r.op]
            for n in range(2 if not r.agg else 1):
                add(r.metric, {**labels, "instance": f"a{n}"}, "level", good, bad, period + 40 * n)
    # series the matchers must leave out
    add("node_filesystem_avail_bytes", {"fstype": "tmpfs", "instance": "a"}, "level", 1, 1)
    add("pg_stat_database_deadlocks", {"datname": "template1", "instance": "node-0"}, "reset")
    add("superset_api", {"outcome": "success", "instance": "node-0"}, "reset")
    for p in PANELS.values():
        for n in range(12 if p.top else 2):
            labels = {"instance": f"p{n}"}
            if p.how == "up" or p.metric in {r.metric for r in RULES} and not p.top:
                continue
            if p.by:
                labels[p.by[0]] = f"{p.by[0]}-{n}"
            if p.where and p.where[0] == "name":
                labels["name"] = f"c{n}"
            if p.how == "rate":
                add(p.metric, labels, "steps", period=3 + n)
            else:
                add(p.metric, labels, "level", 100 + n, 200 - n, 100 + 10 * n)
    return list(out.values())


SPECS = _specs()
