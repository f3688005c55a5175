"""Sources: line-numbered files, manifests, labels, document files, corpora."""

from corpusml.sources.buckets import bucketed_joint_corpus, ingest_buckets, write_buckets
from corpusml.sources.corpus import (
    KINDS, document_url, ingest_documents, joint_corpus, joint_token_bags, labelled_manifest, load_corpus,
    normalize_base, read_documents, read_labels, read_manifest, scan_documents, tokenize,
)
from corpusml.sources.files import document_names, write_documents
from corpusml.sources.lines import explode_lines, read_lines, split_lines

__all__ = [
    "KINDS", "bucketed_joint_corpus", "document_url", "explode_lines", "ingest_buckets", "ingest_documents", "joint_corpus", "joint_token_bags",
    "labelled_manifest", "load_corpus", "normalize_base", "read_documents", "read_labels", "read_lines",
    "read_manifest", "scan_documents", "split_lines", "tokenize", "write_buckets",
]
