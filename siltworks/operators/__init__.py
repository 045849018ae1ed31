"""siltworks.operators"""
