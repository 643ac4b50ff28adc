"""siltstone.sources"""
