"""Document sources and sinks, and the test-table document collections."""

from kindred.sources.documents import read_documents, write_documents  # noqa: F401
