"""Readers and writers: pair files, listings, archives, images and shards."""
