"""siltworks.functions"""
