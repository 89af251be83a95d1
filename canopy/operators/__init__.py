"""canopy.operators"""
