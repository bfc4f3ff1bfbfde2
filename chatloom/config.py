"""What the operators take as arguments: names, thresholds, rules and word lists. No persona text ships here."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Rule:
    """A pattern that rejects a turn. scope: any, or assistant; lower-cased text is searched unless raw."""

    rank: int
    scope: str
    pattern: str
    reason: str
    raw: bool = False


@dataclass(frozen=True)
class Config:
    persona: str = "assistant"
    min_turns: int = 8
    max_turns: int = 24
    min_lines: int = 3
    emoji_cap: int = 4
    rules: tuple[Rule, ...] = ()
    #: Whole-word replacements for assistant turns.
    words: dict[str, str] = field(default_factory=dict)
    scene_patterns: tuple[str, ...] = ()
    overused_stems: tuple[str, ...] = ()
    overused_max: int = 3
    refusal_phrases: tuple[str, ...] = ()
    signature_threshold: tuple[int, int] = (9, 10)
    opening_threshold: tuple[int, int] = (19, 20)


#: Stage directions between asterisks or at a word's end, and longer remarks in brackets.
NARRATION = r"(?md)\*[^*\n]+\*|(^|[^\p{L}\p{N}_])[A-Za-z]+\*\s*$|\([^)\n]{8,}\)"


def narration_rule(rank: int) -> Rule:
    return Rule(rank, "assistant", NARRATION, "narration_detected", raw=True)
