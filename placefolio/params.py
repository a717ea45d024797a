"""Run parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# Words that mark a link as leading to a priced list, matched as substrings
# ("seafood", "foodmenu" count), and the words that only count when they stand alone.
HINT_WORDS = ("menu", "menus", "dinner", "lunch", "drinks", "food", "carte")
WHOLE_WORDS = ("eat",)
STRONG_HINT = "menu"

# Limits of a run.
MAX_PAGES_PER_QUERY = 3
LINKS_PER_SITE = 3
MAX_BYTES = 3_000_000
MAX_TEXT_CHARS = 20_000
MIN_TEXT_CHARS = 200
MAX_NOTE_CHARS = 160
MAX_SLUG_CHARS = 120
DEFAULT_TARGET = 200
DEFAULT_SITE_CAP = 200
DEFAULT_CURRENCY = "AUD"


@dataclass(frozen=True)
class LinkHints:
    """Which link texts look like a priced list, and which of the words ranks a link first."""

    words: tuple[str, ...] = HINT_WORDS
    whole_words: tuple[str, ...] = WHOLE_WORDS
    strong: str = STRONG_HINT


def split_list(text: str) -> tuple[str, ...]:
    """Comma list -> trimmed entries without blanks."""
    return tuple(part.strip() for part in text.split(",") if part.strip())


@dataclass(frozen=True)
class RunParams:
    search_queries: tuple[str, ...] = ()
    target_count: int | None = DEFAULT_TARGET
    max_sites: int | None = DEFAULT_SITE_CAP
    currency: str = DEFAULT_CURRENCY
    reset_tables: bool = False
    user_agent: str = "placefolio/1.0 (+respects robots.txt)"
    object_root: str = "raw"
    min_text_chars: int = MIN_TEXT_CHARS
    # Limits that ``None`` switches off: pages read per query, candidates tried per site, bytes read of a body,
    # characters kept of a text.
    max_pages_per_query: int | None = MAX_PAGES_PER_QUERY
    links_per_site: int | None = LINKS_PER_SITE
    max_bytes: int | None = MAX_BYTES
    max_text_chars: int | None = MAX_TEXT_CHARS
    # Replace the places of this run in the stored tables and keep the others, instead of a full refresh.
    upsert: bool = False
    # Key buckets of the stored tables and versions of them that stay on disk.
    table_buckets: int = 16
    keep_versions: int = 2
    # Tries of a call to document parser or extraction function.
    call_attempts: int = 1
    # Name of what gives the answers, such as a model with its version. With a name, answers are kept in a table and
    # never asked for again; a new name asks for all anew.
    answers_of: str = ""
    # Write down which rule of the response contract each broken answer breaks.
    keep_rejects: bool = False
    hints: LinkHints = field(default_factory=LinkHints)

    @classmethod
    def from_strings(cls, search_queries: str = "", target_count: str = str(DEFAULT_TARGET),
                     max_sites: str = str(DEFAULT_SITE_CAP), currency: str = "",
                     reset_tables: str = "false", **other) -> RunParams:
        """Parameters as a job scheduler passes them: all strings. A blank cap is no cap."""
        def cap(text: str) -> int | None:
            return int(text) if text.strip() else None

        return cls(search_queries=split_list(search_queries), target_count=cap(target_count),
                   max_sites=cap(max_sites), currency=currency.strip() or DEFAULT_CURRENCY,
                   reset_tables=reset_tables == "true", **other)
