"""Stand-ins of external models for the queries and tests: deterministic functions of what they are asked, faults included."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field


def marked(text: str) -> str:
    return text.replace("e", "E")


@dataclass
class Replay:
    """Answers items; of several it leaves some out and answers the first twice."""

    of: Callable[[str], str] = marked

    def answer(self, kind: str, items: list[tuple[int, str]]) -> list[tuple[int, str]]:
        if len(items) == 1:
            return [(items[0][0], self.of(items[0][1]))]
        out = [(i, self.of(t)) for i, t in items if i % 7 != 3]
        return out + [(i, self.of(t)) for i, t in items[:1] if i % 5 == 2]


@dataclass
class PolishReplay:
    """Answers chats of a polish: never for files whose number ends in 4, for others that end in an even digit only when
    asked again. Items are left out, changed, deleted or drawn out by their place in the file."""

    asked: set[str] = field(default_factory=set)

    def chat(self, kind: str, request: str) -> str:
        items = json.loads(request)["items"]
        stem = int(items[0]["file"])
        if stem % 10 == 4 or (stem % 2 == 0 and request not in self.asked):
            self.asked.add(request)
            raise ConnectionError("no answer")
        out = []
        for x in items:
            k = x["seq"] % 6
            if k == 1:
                out.append({"id": x["id"], "zh": f"润色{x['seq']}"})
            elif k == 2:
                out.append({"id": x["id"], "delete": True})
            elif k == 3:
                out.append({"id": x["id"], "zh": "长" * 500})
            elif k == 4:
                out.append({"id": str(x["id"]), "zh": "注"})
            elif k == 5:
                out += [{"id": None, "zh": "x"}, "no item", {"id": x["id"] + 1000, "zh": "多"}]
        return f"<think>{{}}</think>```json\n{json.dumps({'items': out}, ensure_ascii=False)}\n```"


@dataclass
class NoteReplay:
    """Finds one note in each batch, at its first item; files whose number leaves 3 by 7 get none, as an error or an answer
    without JSON. Notes without wording, and what is none, are for the caller to leave out."""

    def chat(self, kind: str, request: str) -> str:
        items = json.loads(request)
        first = items[0]
        if first["stem"] % 7 == 3:
            if first["stem"] % 2:
                raise TimeoutError("no answer")
            return "I found nothing."
        note = {"term": "Grand  Harbour", "zh": f"大港口注释共{len(items)}", "start": first["start"], "end": first["start"] + 1.0}
        return json.dumps({"notes": [note, {"term": "Nobody", "zh": " "}, "none"]}, ensure_ascii=False)


@dataclass
class ScreenReplay:
    """Classifies screen texts by their number: kept with a translation, dropped, kept without one, or left out; files whose
    number leaves 5 by 11 get no answer."""

    def chat(self, kind: str, request: str) -> str:
        items = json.loads(request)["items"]
        if int(items[0]["file"]) % 11 == 5:
            raise ConnectionError("no answer")
        out = []
        for x in items:
            k = x["seq"] % 5
            if k in (0, 3):
                out.append({"id": x["id"], "zh": f"字{x['seq'] % 3}"})
            elif k in (1, 2):
                out.append({"id": x["id"], "keep": k == 2, "zh": ""})
        return json.dumps({"items": out}, ensure_ascii=False)
