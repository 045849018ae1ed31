"""siltworks.sources"""
