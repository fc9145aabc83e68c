"""Named queries, grouped by layer. Importing a module registers its queries."""

from motorlake.checks.queries import (  # noqa: F401
    extract, files, functions, gold, parsing, quality, silver, streaming,
)
