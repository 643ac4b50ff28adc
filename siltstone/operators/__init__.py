"""siltstone.operators"""
