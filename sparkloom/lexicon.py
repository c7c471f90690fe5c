"""Word lists, tables and patterns. Results depend on them."""

from __future__ import annotations

import unicodedata

# Fixed values.
STOPWORDS = (
    "cual como para este esta estos estas sobre desde hasta entre donde cuando que del las los una uno unos unas con sin por "
    "what which how does that with from have has this these those the and for"
).split()
# Language, name and marker words, in the order that settles ties.
LANGUAGES = (
    ("en", "English", "the and of to in is are that with for from this these which system software computer".split()),
    ("es", "Spanish", "el la los las de del que en es son para con por como sistema software computadora".split()),
    ("ca", "Catalan", "el la els les de del que en es son per amb com sistema programari ordinador".split()),
    ("fr", "French", "le la les des de du que dans est sont pour avec par comme systeme logiciel ordinateur".split()),
    ("pt", "Portuguese", "o a os as de do da que em e sao para com por como sistema software computador".split()),
)
# What a sentence fragment should not end with.
BAD_ENDINGS = "a an and as at because by for from in into of offering on or that the to with".split()
# Vocabularies of three fields.
DOMAINS = {
    "technical": (
        "technical analysis indicator indicators bollinger ema cci historical price-based trend trends sentiment trader traders "
        "emh efficient hypothesis noise mispricing mispricings"
    ).split(),
    "ml": (
        "machine learning neural network networks lstm transformer transformers gradient boosting reinforcement model models "
        "adaptive framework frameworks algorithm algorithms"
    ).split(),
    "hft": (
        "high-frequency frequency microstructure microstructures latency minute order flow trading out-of-sample in-sample "
        "buy-and-hold tail volatility risk profitability"
    ).split(),
}
# Words too general to tell topics apart.
GENERIC_TERMS = (
    "approach approaches analysis applications based chapter concept concepts design document framework general implementation "
    "introduction method methods overview paper section study system systems topic topics using"
).split()
# Phrases of general topic names.
GENERIC_NAMES = ("concept", "concepts", "theory", "references", "literature", "history and literature", "structure and concepts")
# Headings that are no topics.
BLOCKED_HEADINGS = ("operating system", "components", "history", "popular operating systems", "references")
# Joined words and their repair.
JOINED_WORDS = (
    ("riskadjusted", "risk-adjusted"),
    ("riskreward", "risk-reward"),
    ("gainsloss", "gains-loss"),
    ("highfrequency", "high-frequency"),
    ("outofsample", "out-of-sample"),
    ("insample", "in-sample"),
    ("pricebased", "price-based"),
    ("timeseries", "time-series"),
)
# What a wrong decoding as Windows-1252 makes of characters, in the order of replacement.
MISREAD_PAIRS = (
    ("â€“", "–"),
    ("â€”", "—"),
    ("â€œ", "“"),
    ("â€Ž", "”"),
    ("â€˜", "‘"),
    ("â€™", "’"),
    ("Î¸", "θ"),
    ("Î±", "α"),
    ("Î²", "β"),
    ("Î³", "γ"),
    ("Î´", "δ"),
    ("Ïƒ", "σ"),
    ("Î¼", "μ"),
    ("Î»", "λ"),
    ("âˆˆ", "∈"),
    ("âˆ‘", "∑"),
    ("âˆš", "√"),
    ("â‰¤", "≤"),
    ("â‰¥", "≥"),
    ("Â±", "±"),
    ("Â·", "·"),
    ("\u00a0", " "),
    ("\u0000", ""),
)
# What decoding wrongly twice makes of dashes and quotes, in the order of replacement.
TWICE_MISREAD = (
    ("Ã¢â‚¬â€", " - "),
    ("Ã¢â‚¬â€œ", " - "),
    ("Ã¢â‚¬Ëœ", "'"),
    ("Ã¢â‚¬â„¢", "'"),
    ('Ã¢â‚¬Å"', '"'),
    ("Ã¢â‚¬Â", '"'),
)
# Signs of such text that was not repaired.
MISREAD_PATTERN = "â€|Î[¸±²³´µ¼»]|Ïƒ|âˆˆ|Ã¢"
# Openings of answers in the authors' voice and their replacement.
VOICE = (
    ("Our findings ", "The paper's findings "),
    ("Our results ", "The paper's results "),
    ("Our study ", "The study "),
    ("Our paper ", "The paper "),
    ("We assess ", "The paper assesses "),
    ("We analyze ", "The paper analyzes "),
    ("We analyse ", "The paper analyses "),
    ("We evaluate ", "The paper evaluates "),
    ("We examine ", "The paper examines "),
    ("We find ", "The paper finds "),
    ("We show ", "The paper shows "),
    ("We propose ", "The paper proposes "),
    ("We present ", "The paper presents "),
)
# Item, gate, judge and retrieval enumerations.
TYPES = ("factual", "conceptual", "inference", "compare", "definition")
DIFFICULTIES = ("easy", "medium", "hard")
GATES = ("strict", "balanced", "off")
JUDGE_MODES = ("audit", "filter", "off")
RETRIEVAL = ("lexical", "semantic", "hybrid")
DECISIONS = ("pass", "review", "fail")
BLOCKING_REASONS = ("cross_chunk_context", "extraction_artifact", "overly_extractive", "truncated_context", "unsupported_detail", "weak_context")
REASONS = (*BLOCKING_REASONS, "factual", "judge_error", "unclear_question")


def folded_letters() -> tuple[str, str]:
    """Letters of Latin-1 and Latin Extended-A whose decomposition is one letter and marks, and that letter."""
    pairs = []
    for code in range(0xC0, 0x180):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(c))
        if len(plain) == 1 and plain != chr(code) and chr(code) == chr(code).lower():
            pairs.append((chr(code), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)
