"""siltworks.streaming"""
