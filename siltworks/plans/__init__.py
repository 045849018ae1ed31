"""siltworks.plans"""
