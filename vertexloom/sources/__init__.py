"""Readers and writers of the file forms that the operators work on."""
