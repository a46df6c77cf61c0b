"""Explicit schemas of the tables and streams."""

from __future__ import annotations

from pyspark.sql import types as T

_d, _l, _s, _b, _f = T.DoubleType(), T.LongType(), T.StringType(), T.BooleanType(), T.FloatType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


#: One spectrum: arrays over channel.
VISIBILITY = _struct(time=_d, scan=_l, field=_l, ant1=_l, ant2=_l, beam=_l, pol=_s, u=_d, v=_d, w=_d,
                     re=T.ArrayType(_f), im=T.ArrayType(_f), flag=T.ArrayType(_b), sigma=T.ArrayType(_f))

#: One datagram: the payload is a slice of baselines.
DATAGRAM = _struct(version=_l, slice=_l, timestamp=_l, block=_l, card=_l, channel=_l, freq=_d, beam=_l,
                   payload=T.ArrayType(_struct(re=_d, im=_d)))

#: Telescope metadata as sent: typed values by name.
TYPED_VALUES = _struct(timestamp=_l, data=T.MapType(_s, _struct(type=_s, value=_s)))

#: Sky-model component.
COMPONENT = _struct(id=_l, component_id=_s, ra=_d, dec=_d, ra_err=_f, dec_err=_f, freq=_f, flux_peak=_f, flux_peak_err=_f, flux_int=_f,
                    flux_int_err=_f, maj_axis=_f, min_axis=_f, pos_ang=_f, spectral_index=_f, spectral_curvature=_f, healpix_index=_l,
                    sb_id=_l, observation_date=T.TimestampType(), data_source=_s)

#: Calibration terms in long form.
GAIN = _struct(time=_l, ant=_l, beam=_l, g1_re=_d, g1_im=_d, g1_valid=_b, g2_re=_d, g2_im=_d, g2_valid=_b)
LEAKAGE = _struct(time=_l, ant=_l, beam=_l, d12_re=_d, d12_im=_d, d21_re=_d, d21_im=_d)
BANDPASS = _struct(time=_l, ant=_l, beam=_l, chan=_l, g1_re=_d, g1_im=_d, g2_re=_d, g2_im=_d)

#: Image pixels.
PIXEL = _struct(image_id=_l, x=_l, y=_l, pol=_s, chan=_l, value=_f, weight=_f, valid=_b)

#: Monitoring points, interference list, log events.
MONITOR = _struct(name=_s, ts=T.TimestampType(), value=_s, type=_s, status=_s, unit=_s)
INTERFERENCE = _struct(rfi_id=_l, f_lo=_d, f_hi=_d, az_lo=_d, az_hi=_d, el_lo=_d, el_hi=_d, t_lo=_d, t_hi=_d)
LOG_EVENT = _struct(origin=_s, created=T.TimestampType(), level=_s, message=_s, tag=_s, host=_s)
