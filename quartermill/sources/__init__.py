"""Readers, the text sink and the sample views over the test tables."""
