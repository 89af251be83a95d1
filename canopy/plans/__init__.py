"""canopy.plans"""
