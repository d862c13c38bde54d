"""Relational operators over corpora: frames in, frames out."""
