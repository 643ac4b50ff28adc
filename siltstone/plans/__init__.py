"""siltstone.plans"""
