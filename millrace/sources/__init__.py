"""Readers and writers: line files, directories, manifests, licenses and published artifacts."""
